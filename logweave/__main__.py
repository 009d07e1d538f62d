"""``python -m logweave <log_dir> ...``: same as ``python -m logweave.cli``."""

from logweave.cli import main

main()
