import hashlib
import random
from functools import reduce

from hypothesis import given, settings
from hypothesis import strategies as st

from pitchlake.llm import exact_dedup as x


def lowered(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lowered(t), []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(t.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda v: (v != keep, str(v))):
            out.append((i, keep, len(ids), i == keep and first, sha))
            first = first and i != keep
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r) for r in x.exact_groups(df).collect()], key=str)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=400), st.lists(st.integers(0, 400), max_size=6))
def test_fingerprints_compose(data, cuts):
    at = sorted({0, len(data), *[min(c, len(data)) for c in cuts]})
    parts = [x.fingerprint(data[a:b]) for a, b in zip(at, at[1:])]
    assert reduce(x.combine, parts, x.EMPTY) == x.fingerprint(data)


def test_long_fingerprint_is_the_polynomial():
    data = random.Random(1).randbytes(3 * x.CHUNK + 17)
    n, hs, _ = x.fingerprint(data)
    want = tuple(reduce(lambda h, c, b=b, p=p: (h * b + c) % p, data, 0) for b, p in zip(x.BASES, x.PRIMES))
    assert (n, hs) == (len(data), want)


def test_edge_rows(documents):
    long = "Word " * 40_000
    rows = [(1, "Abc"), (2, "aBC"), (3, None), (4, ""), (5, "Äb"), (6, "äb"), (7, long), (9, long.upper()), (8, long + "x"),
            (10, "dup"), (10, "dup"), (None, "abc"), (None, "only"), (None, "only")]
    assert result(documents(rows, extra=True)) == brute(rows)


def test_empty_table(documents):
    assert result(documents([]).limit(0)) == []


def test_hot_group_is_salted_and_whole(documents):
    rows = [(i, "same text in many rows") for i in range(1200)] + [(i, f"text {i}") for i in range(1200, 1500)]
    assert result(documents(rows)) == brute(rows)


def test_colliding_fingerprints_are_separated(documents, monkeypatch):
    def weak(batches):
        for b in real(batches):
            cols = [b.column(i) for i in range(b.num_columns)]
            cols[3] = x.pa.array([0] * b.num_rows, x.pa.int64())
            yield x.pa.RecordBatch.from_arrays(cols, b.schema.names)
    real = x._fingerprint_batches
    monkeypatch.setattr(x, "_fingerprint_batches", weak)
    rows = [(i, t) for i, t in enumerate(["aaaa", "bbbb", "AAAA", "cccc", "bbbb", "dddd", "aaaa"])]
    assert result(documents(rows)) == brute(rows)


def test_drop_keeps_columns_and_one_row(documents):
    rows = [(1, "a"), (2, "A"), (3, "b"), (3, "b"), (None, "c"), (4, None), (5, "")]
    df = documents(rows, extra=True)
    got = x.drop_exact_copies(df)
    assert got.columns == df.columns
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted([(2, "A"), (3, "b"), (None, "c"), (5, "")], key=str)


def test_pieces_are_cut_in_proportion_to_length(spark):
    """A walk over the text, not one per piece; surrogate pairs stay whole."""
    import time

    from pyspark.sql import functions as F

    from pitchlake.llm.exact_dedup import COMPARE_CHARS, pieces
    text = "😀ä\nb" * COMPARE_CHARS + "end"
    got = spark.createDataFrame([(text,), ("",), ("x" * COMPARE_CHARS,)], "text string").select(pieces("text").alias("p")).collect()
    assert ["".join(r.p) for r in got] == [text, "", "x" * COMPARE_CHARS]
    assert [len(p) for p in got[0].p] == [COMPARE_CHARS] * 4 + [3] and got[1].p == [""] and len(got[2].p) == 1

    def seconds(mb):
        df = spark.range(1).select(F.repeat(F.lit("abcdefg\n"), mb << 17).alias("text"))
        job = df.select(F.explode(pieces("text")).alias("p")).agg(F.sum(F.length("p")))
        job.collect()
        at = time.perf_counter()
        assert job.first()[0] == mb << 20
        return time.perf_counter() - at
    assert seconds(16) < 24 * seconds(2) + 2   # cut piece by piece from the whole text, it was 64 times and more
