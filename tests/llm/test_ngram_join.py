import random

import pytest

from pitchlake.llm import ngram_join as x


def shingles(t):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), (min(ids) if ids else None) if sets[i] else d))
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r) for r in x.ngram_groups(df).collect()], key=str)


def near_copies(seed, bases=6, copies=25, edit=0.02, length=60):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(1, 4)))
    rows = []
    for _ in range(bases):
        base = [word() for _ in range(r.randint(3, length))]
        for _ in range(copies):
            w = [word() if r.random() < edit * r.choice([0, 1, 2, 4]) else v for v in base]
            cut = r.randint(0, 3)
            rows.append(" ".join(w[cut:] if r.random() < 0.4 else w))
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", range(4))
def test_near_copies(documents, seed):
    rows = near_copies(seed)
    assert result(documents(rows)) == brute(rows)


def test_shared_lines_and_short_texts(documents):
    r = random.Random(9)
    lines = ["one two three four five six seven", "alpha beta gamma delta epsilon", "x y", "p q r s t u v w"]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(1, 4)))) for i in range(80)]
    assert result(documents(rows)) == brute(rows)


def test_open_lists_are_compared_in_full(documents, monkeypatch):
    monkeypatch.setattr(x, "STARS", 1)  # leaves work for the last step
    rows = near_copies(11, bases=3, copies=40, edit=0.03)
    assert result(documents(rows)) == brute(rows)


def test_exactly_the_threshold(documents):
    w = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(w[:104])), (2, " ".join(w[:84])), (3, " ".join(w[:83])), (4, " ".join(w[:129]))]  # 100, 80, 79, 125
    assert result(documents(rows)) == brute(rows)


def test_edge_rows(documents):
    long = " ".join(f"v{i % 997} u{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B"), (6, "a b c d e"), (6, "a b c d e"), (None, "a b c d e"),
            (None, "none has an id"), (None, "none has an id"), (7, long), (8, long + " tail"), (9, "\xa0x y")]
    assert result(documents(rows, extra=True)) == brute(rows)


def test_empty_table(documents):
    assert result(documents([]).limit(0)) == []


def test_drop_keeps_one_of_each_component(documents):
    rows = near_copies(3)
    df = documents(rows, extra=True)
    got = x.drop_near_copies(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted({r[2] for r in brute(rows)})


def test_packing():
    import numpy as np
    v = np.array([0, 1, 255, 256, 2 ** 40, 2 ** 47], dtype=np.uint64)
    assert (x._unpack(x._pack(v)) == v).all()
    assert (x._unpack_sorted(x._pack_sorted(v)) == v).all()


@pytest.mark.parametrize("seed", [5, 6])
def test_dealing_in_two_steps(documents, monkeypatch, seed):
    monkeypatch.setattr(x, "HOME_BYTES", 1000)
    monkeypatch.setattr(x, "GROUP_BYTES", 500)
    monkeypatch.setattr(x, "FAN", 4)
    rows = near_copies(seed) + [(None, "has no id at all but these words"), (900, None), (901, "a b"), (902, "A  B")]
    to = x.layout(sum(len(t or "") for _, t in rows), 8)
    assert to.step > 1 and to.salts > 1
    assert result(documents(rows)) == brute(rows)


def test_layout_covers_every_range():
    for size, least in [(0, 1), (10 ** 9, 32), (10 ** 11, 200), (10 ** 12, 8), (10 ** 14, 200)]:
        to = x.layout(size, least)
        coarse, fine = to.bounds(to.step), to.bounds()
        assert coarse[0] == fine[0] == 0 and coarse[-1] == fine[-1] == 1 << x.TOKEN_BITS
        assert coarse[:-1] == fine[:-1:to.step]
        assert to.homes * x.HOME_BYTES >= size
        assert {to.first(to.key(d, s)) for d in (0, to.step, to.buckets - 1) for s in (0, 7)} <= set(range(0, to.buckets, to.step))


@pytest.mark.parametrize("share", [0.83, 0.87, 0.885])
def test_texts_that_share_most_without_linking(documents, monkeypatch, share):
    """Lists of all texts stay open: none of their members link."""
    monkeypatch.setattr(x, "STARS", 0)
    common = [f"c{i}" for i in range(400)]
    rows = []
    for d in range(300):
        own = round(400 * (1 - share) / share) + d % 7
        rows.append((d, " ".join(common + [f"u{d}x{i}" for i in range(own)])))
    assert result(documents(rows)) == brute(rows)


def test_rest_in_blocks(documents, monkeypatch):
    """Random choices of lines: many pairs are compared, few of them link."""
    monkeypatch.setattr(x, "STARS", 0)
    monkeypatch.setattr(x, "BLOCK", 7)
    r = random.Random(4)
    lines = [" ".join(f"{r.randrange(500)}" for _ in range(8)) for _ in range(40)]
    rows = [(d, "\n".join(v for v in lines if r.random() < r.choice([0.85, 0.9, 0.97]))) for d in range(90)]
    assert result(documents(rows)) == brute(rows)


def test_rest_pairs_are_those_of_both_filters(spark):
    r = random.Random(8)
    rows = []
    for b in range(150):
        n = r.randint(1, 60)
        for token in r.sample(range(6), 3):
            rows.append((token, b, n, r.randint(0, n // 5), r.randint(0, 40)))
    df = spark.createDataFrame(rows, "token bigint, b bigint, n_b bigint, place_b bigint, root_b bigint")
    want = set()
    for t, a, na, pa, ra in rows:
        for u, b, nb, pb, rb in rows:
            if t == u and ra != rb and (na, a) < (nb, b) and 100 * na >= 80 * nb and 180 * min(na - pa, nb - pb) >= 80 * (na + nb):
                want.add((a, b, na, nb))
    assert {tuple(p) for p in x._rest_pairs(df).collect()} == want
