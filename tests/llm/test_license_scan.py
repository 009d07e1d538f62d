import random

from logweave.llm.license_scan import BASE, CHARS_PER_EDIT, NOTICES, Scanner, license_digest, pieces, scan_licenses

SF = "/root/testdata/sf0.01"


def words_of(text):
    out, word = [], ""
    for ch in (text or "") + " ":
        if ch.isascii() and not ch.isalnum():
            out += [word] if word else []
            word = ""
        else:
            word += ch.lower() if ch.isascii() else ch
    return out


def brute_base(text):
    w = words_of(text)
    found = []
    for phrase, label in BASE.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return len(w), sorted(found)


def least_edits(notice, text):
    """Smallest edit distance between the notice and any stretch of the text (Sellers)."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(notice, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_base_columns_of_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    some = 0
    for r in license_digest(docs).collect():
        n, found = brute_base(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (n, len(found))
        assert (r.first_word, r.last_word) == ((found[0][0], found[-1][0]) if found else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and (r.score == 1.0 or not found)
        some += bool(found)
    assert some > 10


def edited(rng, text, k):
    t = list(text)
    for _ in range(k):
        p = rng.randrange(len(t))
        what = rng.randrange(3)
        if what == 0:
            t[p] = rng.choice("abcxyz")
        elif what == 1:
            del t[p]
        else:
            t.insert(p, rng.choice("abcxyz"))
    return "".join(t)


def test_fuzzy_equals_brute_force():
    rng = random.Random(7)
    scan = Scanner({}, NOTICES)
    filler = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(30))
    for notice, label in NOTICES.items():
        k = len(notice) // CHARS_PER_EDIT
        for edits in (0, 1, k // 2, k, k + 3, 3 * k):
            text = f"{filler} {edited(rng, notice, edits)} {filler}"
            joined = " ".join(words_of(text))
            want = {other for other in NOTICES if least_edits(other, joined) <= len(other) // CHARS_PER_EDIT}
            n, found = scan(text.encode())
            assert {f["label"] for f in found} == {NOTICES[o] for o in want}
            for f in found:
                w = words_of(text)
                assert f["text"] in " ".join(w[f["first_word"] : f["first_word"] + f["n_words"]])


def test_every_place_is_reported(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    text = f"x {notice} y\n{notice.replace('Apache', 'Apahce')} z {notice}"
    [r] = scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(f.first_word, f.edits) for f in r.found if not f.base] == [(1, 0), (10, 2), (19, 0)]
    assert [f.first_word for f in r.found if f.base] == [4, 22]


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "...!"), (None, "MIT License"), (4, "cc by cc by"), (4, "cc by cc by"), (5, "ümit license"), (6, "a " * 200_000 + "Apache\nLicense"), (7, "CC-BY\x00MIT-LICENSE"), (8, "released under the mlt license")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as found", "'x' as score")
    got = sorted((r.doc_id or -1, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 3)) for r in license_digest(docs).collect())
    assert got == [
        (-1, 2, 1, 0, 0, "mit", "mit", 1.0), (1, 0, 0, None, None, "", "", 0.0), (2, 0, 0, None, None, "", "", 0.0), (3, 0, 0, None, None, "", "", 0.0),
        (4, 4, 2, 0, 2, "cc-by", "cc-by", 1.0), (4, 4, 2, 0, 2, "cc-by", "cc-by", 1.0), (5, 2, 0, None, None, "", "", 0.0),
        (6, 200_002, 1, 200_000, 200_000, "apache", "apache", 1.0), (7, 4, 2, 0, 2, "cc-by,mit", "cc-by,mit", 1.0), (8, 5, 0, None, None, "", "mit", 0.967),
    ]


def test_empty(spark):
    assert license_digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pieces_cover_the_notice():
    for notice in NOTICES:
        k = len(notice) // CHARS_PER_EDIT
        parts = pieces(notice, k)
        assert len(parts) == k + 1 and "".join(p for _, p in parts) == notice and all(notice[a:].startswith(p) for a, p in parts)


def test_two_edits_in_a_short_notice():
    _, [found] = Scanner({}, NOTICES)(b"released under the mlt licence")
    assert (found["label"], found["edits"], round(found["score"], 3)) == ("mit", 2, 0.933)
    _, [found] = Scanner({}, NOTICES)(b"lisensed under cc by nc 4 o")
    assert (found["label"], found["edits"]) == ("cc-by-nc", 2)
