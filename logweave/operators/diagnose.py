"""Diagnoses for anomaly reports.

* ``fallback_diagnose`` - rule-based diagnosis for every report.
* ``build_prompts`` / ``build_requests`` - the analysis prompt and the chat request
  body per report, as a table to hand to whatever job calls the model.
* ``parse_responses`` - strict decoding of a ``(request_id, status, body)`` table of
  model responses.
* ``diagnose`` - per report, the decoded response when it is valid, else the
  fallback (a left join; no external call happens inside Spark).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.functions.text import format_rfc3339_seconds, trim_prefix, trim_space, trim_suffix
from logweave.operators.correlate import ENTRY_ORDER, dedup_entries
from logweave.operators.rules import severity_of
from logweave.params import Params

# Fixed texts (must stay as they are).
FALLBACK_PREFIX = "Rule-based detection: "
FALLBACK_RECOMMENDATION = "Investigate the flagged services. Consider adding circuit breakers and retries with backoff."
SYSTEM_PROMPT = (
    "You are an expert distributed systems engineer performing root cause analysis on microservice logs. "
    "Analyze the logs and deduce which service caused the fault. Respond ONLY with valid JSON in this format: "
    '{"root_cause": "...", "recommendation": "...", "severity": "critical|warning|info"}. '
    "Do not wrap the JSON in markdown code blocks or add introductory text."
)
PROMPT_HEADER = "Analyze the following anomalous request flow (request_id: %s).\n\n"
PROMPT_RULES = "Triggered anomaly rules: %s\n\n"
PROMPT_ENTRIES = "Log entries (chronological):\n"
PROMPT_ENTRY = "  [%s] %s | %s | %s | latency=%dms\n"
PROMPT_OMITTED = "\n  ... [%d logs omitted to fit token limits] ...\n\n"
PROMPT_FOOTER = "\nProvide root cause analysis, a recommended fix, and severity level."

DIAGNOSIS_COLUMNS = ["request_id", "root_cause", "recommendation", "severity"]


def fallback_columns(rules: Column) -> list[Column]:
    """``root_cause, recommendation, severity`` of the rule-based diagnosis."""
    return [
        F.concat(F.lit(FALLBACK_PREFIX), F.array_join(rules, ", ")).alias("root_cause"),
        F.lit(FALLBACK_RECOMMENDATION).alias("recommendation"),
        severity_of(rules).alias("severity"),
    ]


def fallback_diagnose(reports: DataFrame) -> DataFrame:
    """Rule-based diagnosis; keeps ``start_ts, start_nanos`` for alert ordering."""
    return reports.select("request_id", *fallback_columns(F.col("rules")), "start_ts", "start_nanos")


# --------------------------------------------------------------------- prompts

def prompt_entries(entries: DataFrame, params: Params = Params()) -> DataFrame:
    """The entry lines a prompt shows, at most ``prompt_max_entries`` per request.

    Requests with more entries keep the first ``prompt_head`` and the last
    ``prompt_tail``. Both selections are ``row_number() <= k`` filters, which Spark
    runs as a partial group limit before the shuffle, so a request with millions
    of lines ships at most k rows per map task. Returns ``request_id, n_entries,
    part (0 head, 1 tail), ts, ts_nanos, raw, line``.
    """
    d = dedup_entries(entries)
    cols = ["request_id", "ts", "ts_nanos", "raw", entry_line().alias("line")]
    counts = d.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_entries"))

    def end(descending: bool, k: int) -> DataFrame:
        order = [F.col(c).desc() if descending else F.col(c).asc() for c in ENTRY_ORDER]
        rn = F.row_number().over(Window.partitionBy("request_id").orderBy(*order))
        return d.withColumn("_rn", rn).where(F.col("_rn") <= k)

    # Both ends are cut to their bound first (a partial group limit runs before the
    # shuffle); the joins with the counts then move at most these rows per request.
    head = (
        end(False, params.prompt_max_entries).join(counts, "request_id")
        .where((F.col("n_entries") <= params.prompt_max_entries) | (F.col("_rn") <= params.prompt_head))
        .select(*cols, "n_entries", F.lit(0).alias("part"))
    )
    tail = (
        end(True, params.prompt_tail).join(counts.where(F.col("n_entries") > params.prompt_max_entries), "request_id")
        .select(*cols, "n_entries", F.lit(1).alias("part"))
    )
    return head.unionByName(tail)


def entry_line() -> Column:
    """How a prompt shows an entry."""
    return F.format_string(
        PROMPT_ENTRY, format_rfc3339_seconds("ts", "tz_offset"), F.col("service"), F.col("level"), F.col("message"), F.col("latency_ms")
    )


def prompt_text(head: Column, tail: Column, params: Params) -> Column:
    """The prompt of ``request_id``, ``rules`` and ``n_entries`` around the texts of its first and last entry lines."""
    omitted = F.when(
        F.col("n_entries") > params.prompt_max_entries,
        F.format_string(PROMPT_OMITTED, F.col("n_entries") - F.lit(params.prompt_max_entries)),
    ).otherwise(F.lit(""))
    return F.concat(
        F.format_string(PROMPT_HEADER, F.col("request_id")),
        F.format_string(PROMPT_RULES, F.array_join("rules", ", ")),
        F.lit(PROMPT_ENTRIES),
        F.coalesce(head, F.lit("")),
        F.coalesce(omitted, F.lit("")),
        F.coalesce(tail, F.lit("")),
        F.lit(PROMPT_FOOTER),
    )


def build_prompts(entries: DataFrame, reports: DataFrame, params: Params = Params()) -> DataFrame:
    """``request_id, prompt`` for every report.

    The bounded per-request selection runs first (dedup hashes on the line, the
    group limits cut each request to at most head + tail rows before shuffling);
    only these rows meet the reports, and only reported requests' lines are
    collected, so no join ever shuffles all entries of a hot request id.
    """
    kept = prompt_entries(entries, params).join(reports.select("request_id"), "request_id", "left_semi")
    lines = kept.groupBy("request_id").agg(
        F.first("n_entries").alias("n_entries"),
        F.array_sort(F.collect_list(F.struct("part", "ts", "ts_nanos", "raw", "line"))).alias("_lines"),
    )
    text_of = lambda part: F.array_join(
        F.transform(F.filter("_lines", lambda x: x["part"] == part), lambda x: x["line"]), ""
    )
    body = prompt_text(text_of(0), text_of(1), params)
    return reports.select("request_id", "rules").join(lines, "request_id", "inner").select("request_id", body.alias("prompt"))


def build_requests(prompts: DataFrame, params: Params = Params()) -> DataFrame:
    """``request_id, body``: chat-completion request JSON per prompt."""
    messages = F.array(
        F.struct(F.lit("system").alias("role"), F.lit(SYSTEM_PROMPT).alias("content")),
        F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content")),
    )
    body = F.to_json(
        F.struct(
            F.lit(params.model).alias("model"),
            messages.alias("messages"),
            F.lit(params.temperature).cast("float").alias("temperature"),
        )
    )
    return prompts.select("request_id", body.alias("body"))


# ------------------------------------------------------------ strict decoding

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "allowUnquotedFieldNames": "false"}
#: Stands before the text of every JSON string, so that a decoded string cannot be taken for another value.
MARK = "s:"


def marked(text: Column) -> Column:
    """The same JSON with ``MARK`` at the start of every string, keys included; invalid text stays invalid.

    Escaped backslashes and quotes become their ``\\u`` form first, so that a string ends at the next quote.
    """
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022"))
    return F.regexp_replace(plain, '"([^"]*+)"', f'"{MARK}$1"')


def strict_object(text: Column) -> Column:
    """Decode ``text`` as exactly one JSON object (or ``null``) -> ``map<string,string>`` of marked values.

    Returns a struct ``(ok, obj)``. ``ok`` is false for anything that is not a single
    valid JSON object/null: trailing text, a second value, trailing commas, NaN,
    leading zeros, raw control characters, single quotes, empty text, or a
    non-object value. Keys and strings start with ``MARK``; objects, arrays and other values
    are their JSON text, so what is ignored is never decoded further and may repeat keys.
    Duplicate keys are kept in order (the last one wins).
    """
    json = marked(text)
    arr = F.from_json(F.concat(F.lit("["), json, F.lit("]")), "array<map<string,string>>", _STRICT)
    # Spark's JSON reader stops after the first complete value, so text could close
    # the '[' wrapper early with ']' and hide trailing text. A second wrapper that
    # needs '}' to close early, with a sentinel member after the text, catches it:
    # no text closes both wrappers early.
    sentinel = F.from_json(F.concat(F.lit('{"v":'), json, F.lit(',"w":1}')), "v map<string,string>, w int", _STRICT)
    ok = (F.size(arr) == 1) & (sentinel["w"] == 1)
    return F.struct(F.coalesce(ok, F.lit(False)).alias("ok"), F.get(arr, 0).alias("obj"))


def field_ci(obj: Column, name: str) -> Column:
    """Value of the last key equal to ``name`` ignoring case (NULL when absent or null)."""
    hits = F.filter(F.map_entries(obj), lambda e: F.lower(e["key"]) == MARK + name.lower())
    return F.get(hits, F.size(hits) - 1)["value"]


def _is(v: Column, start: str) -> Column:
    """The value is absent, null, or begins like this kind of JSON value."""
    return F.coalesce(v.startswith(start), F.lit(True))


def _member(v: Column, name: str) -> Column:
    """Member ``name`` of a value, NULL when the value is not an object."""
    return field_ci(F.from_json(F.when(v.startswith("{"), v), "map<string,string>", _STRICT), name)


def _choice_ok(choice: Column) -> Column:
    message = _member(choice, "message")
    return _is(choice, "{") & _is(message, "{") & _is(_member(message, "content"), MARK)


def _text_of(v: Column) -> Column:
    """The text of a marked string; '' for anything else."""
    return F.coalesce(F.when(v.startswith(MARK), F.substring(v, len(MARK) + 1, 2**31 - 1)), F.lit(""))


def _string_field(obj: Column, name: str) -> tuple[Column, Column]:
    """(value or '', type ok): a string or null decodes; any other JSON type is an error."""
    v = field_ci(obj, name)
    return _text_of(v), _is(v, MARK)


def _clean_content(c: Column) -> Column:
    """Strip fences and surrounding text: trim, drop ```json / ``` prefix, ``` suffix, trim,
    then keep the greedy ``{...}`` span if there is one."""
    c = trim_space(trim_suffix(trim_prefix(trim_prefix(trim_space(c), "```json"), "```"), "```"))
    span = F.regexp_extract(c, r"(?s)\{.*\}", 0)
    return F.when(span != "", span).otherwise(c)


def parse_responses(responses: DataFrame) -> DataFrame:
    """Decode ``(request_id, status, body)`` into ``request_id, valid, root_cause, recommendation, severity``.

    ``valid`` is false for a non-200 status, an envelope that is not strict JSON,
    no choices, wrongly typed fields (in any choice) or content that is not one strict
    JSON object; then the decoded columns are NULL. No input raises an error. Of repeated
    keys the last counts, at every level; members that are not asked for may hold anything.
    """
    env = responses.select("request_id", "status", strict_object(F.col("body")).alias("_env"))
    choices = field_ci(F.col("_env.obj"), "choices")
    staged = env.select(
        "request_id", "status",
        F.col("_env.ok").alias("_env_ok"),
        F.from_json(F.when(choices.startswith("["), choices), "array<string>", _STRICT).alias("_choices"),
        _is(choices, "[").alias("_choices_ok"),
    )
    # A typed decode of the whole list: one wrongly typed choice refuses the answer.
    first = _member(_member(F.get(F.col("_choices"), 0), "message"), "content")
    staged = staged.select(
        "request_id", "status", "_env_ok", "_choices_ok",
        F.coalesce(F.forall("_choices", _choice_ok), F.lit(True)).alias("_all_ok"),
        F.coalesce(F.size("_choices"), F.lit(0)).alias("_n_choices"),
        _text_of(first).alias("_content"),
    )
    staged = staged.select("*", strict_object(_clean_content(F.col("_content"))).alias("_d"))
    rc, rc_ok = _string_field(F.col("_d.obj"), "root_cause")
    rec, rec_ok = _string_field(F.col("_d.obj"), "recommendation")
    sev, sev_ok = _string_field(F.col("_d.obj"), "severity")
    rid_ok = _string_field(F.col("_d.obj"), "request_id")[1]
    valid = (
        (F.col("status") == 200) & F.col("_env_ok") & F.col("_choices_ok") & F.col("_all_ok") & (F.col("_n_choices") > 0)
        & F.col("_d.ok") & rc_ok & rec_ok & sev_ok & rid_ok
    )
    decoded = staged.select("request_id", F.coalesce(valid, F.lit(False)).alias("valid"), rc.alias("_rc"), rec.alias("_rec"), sev.alias("_sev"))
    return decoded.select(
        "request_id", "valid",
        F.when(F.col("valid"), F.col("_rc")).alias("root_cause"),
        F.when(F.col("valid"), F.col("_rec")).alias("recommendation"),
        F.when(F.col("valid"), F.col("_sev")).alias("severity"),
    )


def one_response_per_request(decoded: DataFrame) -> DataFrame:
    """At most one decoded response per request id: a valid one first, then by text (deterministic)."""
    best = F.min_by(
        F.struct("valid", "root_cause", "recommendation", "severity"),
        F.struct((~F.col("valid")).alias("_invalid"), "root_cause", "recommendation", "severity"),
    )
    return decoded.groupBy("request_id").agg(best.alias("_r")).select("request_id", "_r.*")


def diagnose(reports: DataFrame, responses: DataFrame | None = None) -> DataFrame:
    """One diagnosis per report: a valid decoded model response, else the rule-based one.

    ``responses=None`` (no model available) plans no join at all.
    """
    fallback = fallback_diagnose(reports)
    if responses is None:
        return fallback
    decoded = one_response_per_request(parse_responses(responses))
    j = fallback.join(decoded.withColumnRenamed("root_cause", "_rc").withColumnRenamed("recommendation", "_rec").withColumnRenamed("severity", "_sev"), "request_id", "left")
    use = F.coalesce(F.col("valid"), F.lit(False))
    return j.select(
        "request_id",
        F.when(use, F.col("_rc")).otherwise(F.col("root_cause")).alias("root_cause"),
        F.when(use, F.col("_rec")).otherwise(F.col("recommendation")).alias("recommendation"),
        F.when(use, F.col("_sev")).otherwise(F.col("severity")).alias("severity"),
        "start_ts", "start_nanos",
    )
