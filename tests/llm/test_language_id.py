import zlib

import numpy as np

from pitchlake.llm import language_id as x

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = x.op5_language_id(spark, SF).collect()
    assert len(rows) == len(want)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == want[r.doc_id] for r in held) >= 0.98 * len(held)


def test_lang_and_source_of_held_out_rows_are_not_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    blind = docs.withColumn("lang", x.F.when(~x.held_out(), x.F.col("lang"))).withColumn("source", x.F.lit("x"))
    key = lambda d: sorted((r.doc_id, r.lang_pred, r.score) for r in x.predict(d, x.train(d)).collect())
    assert key(docs) == key(blind)


def test_edge_rows(spark, documents):
    learn = [(i, t, lang, "s") for i in range(40) for t, lang in
             (("the cat and the dog went there", "en"), ("der hund und die katze gehen dort", "de"))]
    learn = [(k, *row[1:]) for k, row in enumerate(learn)]
    rows = [(1000, None, "en", None), (1001, "", None, "s"), (1002, "123 !? \n", "en", "s"), (None, "the dog", "en", "s"),
            (1003, "und der " * 100_000, None, None), (1004, "the dog", "en", "s"), (1004, "the dog", "en", "s")]
    df = documents(learn + rows, extra=True)
    got = x.predict(df, x.train(df)).collect()
    assert len(got) == len(learn) + len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1000, 1001, 1002, None, 1003, 1004)] == ["und", "und", "und", "en", "de", "en"]
    assert by[None].held_out and by[1000].score == 0


def test_empty_and_unlabelled_tables(spark, documents):
    empty = documents([]).limit(0)
    assert x.train(empty) is None and x.predict(empty, None).collect() == []
    none = documents([(1, "words here", None, "s")])
    assert [(r.lang_pred, r.score) for r in x.predict(none, x.train(none)).collect()] == [("und", 0.0)]


def test_pieces_do_not_change_the_features(monkeypatch):
    text = "Ein längerer Text, in Stücken gelesen. " * 50
    whole = x.presence(text)
    monkeypatch.setattr(x, "PIECE", 37)
    assert (x.presence(text) >= whole).all() and (x.presence(text) != whole).sum() <= 4


def test_kernel_counts_common_grams():
    a, b = x.presence("abcd"), x.presence("abce")
    assert x.kernel(a[None], a[None])[0, 0] == np.float32(1) and 0 < x.kernel(a[None], b[None])[0, 0] < 1


def test_characters_beyond_the_basic_plane(spark, documents):
    assert x.presence("\U0001F600 123 \U0001F389!") is None
    assert (x.presence("a \U0001F600 b") == x.presence("a b")).all()
    assert (x.presence("\U00010400\U00010401") == x.presence("\U00010428\U00010429")).all()  # letters, with their case
    learn = [(k, t, lang, "s") for k, (t, lang) in enumerate([("the cat went there", "en"), ("der hund ging dort", "de")] * 20)]
    df = documents(learn + [(1000, "\U0001F600\U0001F389 1, 2!", None, "s"), (1001, "der hund ging \U0001F600", None, "s")])
    by = {r.doc_id: (r.lang_pred, r.score) for r in x.predict(df, x.train(df)).collect()}
    assert by[1000] == ("und", 0.0) and by[1001][0] == "de"


def plain_grams(text):
    """Distinct n-grams of the lower-cased letters, other runs as one space."""
    low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text)
    low = "".join(c for i, c in enumerate(low) if c != " " or i == 0 or low[i - 1] != " ")
    return {low[i:i + n] for n in range(1, x.SPAN + 1) for i in range(len(low) - n + 1)}


def plain_bin(gram):
    value = 0
    for c in gram:
        value = (value * 0x100000001B3 + ord(c) + 1) % 2 ** 64
    return (value * 0x9E3779B97F4A7C15 % 2 ** 64) >> 49


def test_predictions_equal_a_plain_kernel_regression(spark, documents):
    """Sets of n-grams, the kernel pair by pair, and a ridge regression in the
    span of the landmarks, solved without whitening."""
    docs = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("doc_id", "text", "lang", "source").orderBy("doc_id").collect() if r.text]
    df = documents(docs)
    # the sample has one document a bin at most: read it as the operator draws it
    usable = df.where("lang is not null and text is not null").where(~x.held_out())
    sample = x.one_per_bin(usable, min(x.PER_LANGUAGE, x.MAX_TRAINING // len({d[2] for d in docs if d[2]})), [x.F.col("lang")])
    learn = sorted((r.lang, r.doc_id, r.text) for r in sample.collect())
    assert all(zlib.crc32(str(d).encode()) % 5 for _, d, _ in learn)
    sets = {d: {plain_bin(g) for g in plain_grams(t)} for d, t, *_ in docs}
    alike = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    names = sorted({lang for lang, *_ in learn})
    marks = [sets[d] for k in names for d in [d for lang, d, _ in learn if lang == k][:x.LANDMARKS // len(names)]]
    k_mm = np.array([[alike(a, b) for b in marks] for a in marks])
    k_nm = np.array([[alike(sets[d], b) for b in marks] for _, d, _ in learn])
    share = np.diag([1 / sum(lang == other for other, *_ in learn) for lang, *_ in learn])
    # f = K_nm a + b, with the penalty RIDGE * a' K_mm a
    design = np.column_stack([k_nm, np.ones(len(learn))])
    penalty = np.zeros((len(marks) + 1,) * 2)
    penalty[:-1, :-1] = x.RIDGE * k_mm
    penalty[-1, -1] = 1e-9
    target = np.array([[1.0 if lang == k else -1.0 for k in names] for lang, *_ in learn])
    weights = np.linalg.lstsq(design.T @ share @ design + penalty, design.T @ share @ target, rcond=None)[0]
    got = {r.doc_id: r for r in x.predict(df, x.train(df)).collect()}
    assert len(got) == len(docs)
    for d, _, *_ in docs:
        f = np.array([*(alike(sets[d], b) for b in marks), 1.0]) @ weights
        assert got[d].lang_pred == names[int(f.argmax())], d
        assert abs(got[d].score - min(1, max(0, (f.max() + 1) / 2))) < 1e-3, d
