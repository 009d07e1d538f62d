import duckdb

from logweave.llm.oracle import QUALITY_RULES
from logweave.llm.quality_rules import keep_good, quality_rules, sketch, with_measures

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
SPACE = " \t\n\x0b\x0c\r"


def brute(text):
    text = text or ""
    words, word = [], ""
    for ch in text + " ":
        if ch in SPACE:
            words += [word] if word else []
            word = ""
        else:
            word += ch
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    cover = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover), n < 50 or 100 * len(cover) > 50 * n


def test_base_counts_of_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:7] for r in quality_rules(docs).collect()}
    assert got == {r.doc_id: brute(r.text) for r in docs.collect()}


def test_sql_gives_the_same(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rel = con.sql(QUALITY_RULES)
    assert rel.columns == COLUMNS
    assert sorted(tuple(r) for r in quality_rules(docs).collect()) == sorted(con.sql(QUALITY_RULES).fetchall())


def test_junk_goes_and_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = quality_rules(docs).join(labels, "doc_id").collect()
    long_enough = [r for r in rows if r.n_words >= 50]
    clean = [r.kept for r in long_enough if r.quality == 1]
    junk = [r.kept for r in long_enough if r.quality == 0]
    assert sum(clean) / len(clean) > 0.99 and sum(junk) / len(junk) < 0.05


def test_edge_cases(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(1, good, "en", "a"), (1, good, "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, "\t \n", "en", None), (None, good + " x", None, "b"), (5, "a b c " * 40, "en", "a"), (6, "# " + good, "xx", "new"), (7, "wörd\n" * 30000, "de", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 as n_words", "'k' as kept")
    out = quality_rules(docs)
    assert out.columns == COLUMNS
    for r in out.collect():
        texts = [t for i, t, _, _ in rows if i == r.doc_id]
        assert tuple(r)[1:7] == brute(texts[0])
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted(r.doc_id or -1 for r in out.where("kept").collect())


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality_rules(docs).collect() == [] and keep_good(docs).collect() == []


def test_sketches_merge(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    keys = ["lang", "source", "rule", "bucket"]
    whole = sketch(with_measures(docs, ["lang", "source"]))
    parts = sketch(with_measures(docs.where("doc_id % 3 = 0"), ["lang", "source"])).unionByName(sketch(with_measures(docs.where("doc_id % 3 <> 0"), ["lang", "source"])))
    merged = parts.groupBy(*keys).agg({"n": "sum"}).withColumnRenamed("sum(n)", "n")
    assert sorted(map(str, whole.collect())) == sorted(map(str, merged.collect()))
