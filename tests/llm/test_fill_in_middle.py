"""Fill-in-middle against a plain version; the rank index against all offsets."""

import hashlib
import random
import re

import numpy as np
import pytest

from pitchlake.llm import fill_in_middle as M
from pitchlake.llm.rank_index import EPSILON, boundaries, fit

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    h = hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 80 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc, n, form, len(p), len(m), out


def _texts():
    rng = random.Random(1)
    pool = ["a", "Ärger", " ", "\n", "\t\r", "wörter", "日本語", "\x1f", " ", "x" * 40, "<P", "S>", "<S>", "😀"]
    texts = ["".join(rng.choice(pool) + rng.choice(["", " "]) for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    return [*texts, None, "", " ", "\n\n", "one", " one", "one ", "<M>", "a <S", "<", ">" * 9]


def test_rows_equal_plain_version(documents):
    rows = [(i, t) for i, t in enumerate(_texts())] + [(None, "no id at all"), (7, "again seven"), (7, "again seven")]
    got = sorted((tuple(r) for r in M.fim_rows(documents(rows, extra=True)).collect()), key=str)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert got == sorted(((*(p := plain(*r))[:5], sha(p[5]), sha(r[1])) for r in rows), key=str)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}


def test_transform_keeps_columns_and_can_be_undone(documents):
    rows = [(i, t) for i, t in enumerate(_texts())]
    docs = documents(rows).selectExpr("*", "n_chars * 0 as form")
    out = M.transform(docs, seed=7, fim=90)
    assert out.columns == [*docs.columns, "form_"]
    assert sorted((r.doc_id, M.restore(r.form_, r.text.encode()).decode()) for r in out.collect()) == [(i, t or "") for i, t in rows]
    assert M.transform(docs.limit(0)).count() == 0 and M.fim_rows(docs.limit(0)).count() == 0


@pytest.mark.parametrize("steady", [True, False])
def test_index_answers_every_rank(steady):
    rng = np.random.default_rng(2)
    gaps = np.full(50_000, 6) if steady else rng.integers(1, 8, 50_000) * np.where(rng.random(50_000) < 0.01, 300, 1)
    ends = np.cumsum(gaps)
    index = fit(iter(np.array_split(ends, 37)))
    assert index.n == len(ends) and [index.offset(k) for k in range(0, index.n + 1, 7)] == [0, *ends.tolist()][::7]
    assert sum(map(len, index.residuals)) <= len(ends)
    assert len(index.ranks) == 1 if steady else len(index.ranks) < 4000
    for s, residuals in enumerate(index.residuals):
        assert np.abs(np.frombuffer(residuals, dtype=np.int8).astype(int)).max(initial=0) <= EPSILON + 1, s
    with pytest.raises(IndexError):
        index.offset(index.n + 1)


def test_long_text():
    rng = random.Random(5)
    data = b"".join(rng.choice((b"word", b"a", b"\xc3\xa4\xc3\xb6", b"9" * 300)) + rng.choice((b" ", b"\n\n", b"")) for _ in range(400_000))
    ends = [m.end() for m in re.finditer(rb"[ \t\n\x0b\x0c\r]*[^ \t\n\x0b\x0c\r]+|[ \t\n\x0b\x0c\r]+", data)]
    assert np.concatenate(list(boundaries(data))).tolist() == ends
    index = fit(boundaries(data))
    assert [index.offset(k) for k in range(0, index.n + 1, 997)] == [0, *ends][::997]
    for doc in range(20):
        c = M.cut_text(doc, data)
        assert M.restore(c.form, c.output) == data
