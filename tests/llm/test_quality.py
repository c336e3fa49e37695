from pitchlake.llm import quality as x

SF = "/root/testdata/sf0.1"


def test_accuracy_on_labels_never_learned_from(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = x.quality_scores(docs, x.train(docs)).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.accepted for r in good) >= 0.995 * len(good)
    assert sum(not r.accepted for r in bad) >= 0.98 * len(bad)


def test_em_finds_the_better_labellers():
    import random
    r = random.Random(3)
    accuracy = [0.95, 0.9, 0.75, 0.6, 0.9, 0.8, 0.7, 0.85]
    counts, truth = {}, {}
    for _ in range(20_000):
        good = r.random() < 0.8
        v = "".join("2" if r.random() < 0.3 else str(int(good == (r.random() < a))) for a in accuracy)
        counts[v] = counts.get(v, 0) + 1
        truth[v] = truth.get(v, 0) + good
    post = x.posteriors(counts)
    right = sum((post[v] >= 0.5) * truth[v] + (post[v] < 0.5) * (n - truth[v]) for v, n in counts.items())
    assert right >= 0.95 * 20_000
    assert x.posteriors({}) == {}


def test_edge_rows(spark, documents):
    prose = ("The quick brown fox went over to the lazy dog, and then it slept. It was a good day. Nobody else in that village "
             "knew about the animals, but a few children had seen them by the river on their way home from school.")
    rows = [(i, f"{prose} Number {i}.") for i in range(60)] + [(100 + i, "BUY!! NOW!! " * 30 + str(i)) for i in range(20)]
    rows += [(200 + i, f"word{i} " * (40 + i)) for i in range(20)]
    odd = [(500, None), (501, ""), (502, " \n"), (503, prose * 2000), (504, "w " * 50_000), (None, prose), (1, rows[1][1])]
    df = documents(rows + odd, extra=True)
    scorer = x.train(df)
    got = x.quality_scores(df, scorer).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert not any(by[i].accepted or by[i].score for i in (500, 501, 502))
    assert by[503].accepted and by[None].accepted and by[1].accepted and not by[504].accepted and not by[105].accepted
    kept = x.accepted_documents(df, scorer)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.accepted)


def test_empty_table(documents):
    empty = documents([]).limit(0)
    assert x.train(empty) is None and x.quality_scores(empty, None).collect() == []


def test_scorer_judges_where_all_labellers_abstain(spark):
    """Texts too short for any labeller: what the scorer learned of longer
    ones tells them apart."""
    scorer = x.train(spark.read.parquet(f"{SF}/documents.parquet"))
    bad = ["Ofthstrent### thoner$$$ to%%%", "Erretion | ththinat.", "NDANSH!! ATINTION!! TISTWH!!"]
    good = ["And to the.", "The thing is", "Die einzu der"]
    for text in bad + good:
        raw, words = x._read(text.encode())
        assert set(x.votes(x.statistics(raw, words))) == {str(x.ABSTAIN)}, text
    scores = x._scored([t.encode() for t in bad + good], scorer)
    assert all(s < x.ACCEPT for s in scores[:3]) and all(s >= x.ACCEPT for s in scores[3:])


def test_scorer_sees_words_and_not_statistics():
    """Equal counts of characters, other words: other scores."""
    import numpy as np
    docs = ["the cat sat on the mat"] * 20 + ["eht tac tas no eht tam"] * 20
    rows = [x.features(*x._read(t.encode())) for t in docs]
    scorer = x.fit(rows, np.array([1.0] * 20 + [0.0] * 20))
    a, b = x._scored([b"on the mat the cat sat", b"no eht tam eht tac tas"], scorer)
    assert a > 0.9 and b < 0.1


def test_training_sample_is_bounded_by_its_bins(spark, documents, monkeypatch):
    """Whole documents, in the order of their hash, until the bins are used up."""
    from pyspark.sql import functions as F
    sizes = spark.createDataFrame([(i, 10 + i % 7) for i in range(200)], "doc_id bigint, n bigint")
    order = [(r.doc_id, r.n) for r in sizes.orderBy(F.xxhash64("doc_id")).collect()]
    for bins in (0, 9, 500, 10_000):
        want, reach = [], 0
        for i, n in order:
            reach += n
            want += [i] * (reach <= bins)
        assert sorted(r.doc_id for r in x.within(sizes, bins).collect()) == sorted(want)
    prose = "and the people of the town went to the river with their children, " * 5
    df = documents([(i, f"{prose} number {i}") for i in range(30)] + [(100 + i, f"BUY NOW!! $$$ {i} " * 40) for i in range(30)])
    seen = []
    real = x.fit
    monkeypatch.setattr(x, "fit", lambda rows, y: seen.append(sum(len(at) for at, _ in rows)) or real(rows, y))
    monkeypatch.setattr(x, "SAMPLE_BINS", 3000)
    assert x.train(df) is not None and 0 < seen[0] <= 3000
    monkeypatch.setattr(x, "SAMPLE_BINS", 0)
    assert x.train(df) is None
