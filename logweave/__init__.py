"""logweave: Spark-native log correlation and anomaly analytics.

Every public function takes and returns DataFrames; nothing runs until a sink
or an action is called. The stages mirror a service-log triage run:

    read_logs -> parse_logs -> dedup_entries -> correlate / detect
              -> diagnose (rule fallback or joined model responses)
              -> error_spikes / global_error_spike -> alerts
"""

from logweave.params import Params
from logweave.session import get_session, ensure_checkpoint_dir

__all__ = ["Params", "get_session", "ensure_checkpoint_dir"]
