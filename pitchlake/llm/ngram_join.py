"""N-gram Jaccard join: rare-first prefix filtering over word shingles.

A document is the set of its distinct five-word shingles; two documents link
when ``100 * |x and y| >= 80 * |x or y|``.

1. *Tokens.*  A task hashes the shingles of a slice of documents to 48 bits
   (5 words, vectorised), and deals the distinct (token, document) pairs to
   token ranges, packed and delta-coded, one row per slice and range.
   Documents with the same word sequence are one class; only one of them
   per slice sends tokens.
2. *Document frequencies.*  A range counts the classes of each token.  A
   token in one class only can't be shared and goes no further; the others
   return to their class, again packed.
3. *Prefixes.*  A class orders its tokens rare first: (frequency, token),
   its unshared tokens before all.  Of n tokens the first
   ``n - ceil(0.8 n) + 1`` are its prefix; linked sets share a prefix token.
   A class whose prefix is all unshared links with nothing.
4. *Candidates.*  A token's list of classes is compared as a star: every
   member with the one that has the fewest unshared tokens (among near copies
   that is the text they were made from), after the length filter and the
   positional filter (what follows the pair's first shared token must suffice).  A pair
   met under several tokens is verified once.  Verification cuts both sets
   at common pivots (suffix filter: the parts bound the overlap) and then
   counts the overlap exactly.  A list is joined to its centre in SALTS parts.
5. *Components.*  Verified links give components, each round's on top of the
   last one's; lists whose members have
   come into one component are closed, since more links inside it can't
   change it.  From the others the compared member is taken out and the
   rest compared again, STARS rounds at least and as long as a round halves
   what is open.
6. *Rest.*  In lists that stay open the two filters are turned into a range:
   a set of n tokens that meets a token at place p links only with sets of at
   most (5 n - 9 p) / 4 tokens.  The smaller set of a pair looks for its
   partner in the few bands of sizes of that range, block by block, so that
   no task compares more than BLOCK x BLOCK sets.  Sets without a partner in
   range cost nothing, however long their list is.

So every pair is decided or already connected, and a group of thousands of
near copies costs links in proportion to its size, not its square.

The numbers of ranges and homes follow the bytes of the texts.  Beyond FAN homes
a slice deals to coarse ranges; the slices' rows are united there and dealt
on to the ranges, and in the same way back to the homes, so that the rows sent
grow with the data, not with its square.

Tokens and classes are compared by hash: 48 bits inside a pair of documents,
64 bits for word sequences.

Defined results: null or wordless text has an empty set, no links, and is
its own component; equal texts are one component; a null doc_id never names
a component (it is null where a component has no other id); repeated rows
are returned as often as they come.  Further columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm.common import cut, id_key, in_slices, table, utf8_values
from pitchlake.llm.components import components

WORDS, NEED = 5, 80          # words of a shingle; percent of the union
TOKEN_BITS, INDEX_BITS = 48, 16
SLICE_DOCS, SLICE_BYTES = 8192, 12 << 20  # places of documents fit INDEX_BITS
HOME_BYTES = 64 << 20        # text of the documents in one home of classes
FAN, GROUP_BYTES = 1024, 32 << 20  # more homes than this are dealt to in two steps; text united in the first
STARS, SALTS = 3, 16
BLOCK, BAND = 1024, 1.05     # rest: sets of a block; a band's largest size by its smallest
_MASK = np.uint64((1 << INDEX_BITS) - 1)
_WORD = b" \t\n\x0b\x0c\r"   # bytes.split() parts words at exactly these

META, CLASS, TOKENS = 0, 1, 2


class _WordHashes(dict):
    """64-bit hash of a word, kept while the vocabulary is small."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) < 1 << 18:
            self[word] = value
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit changes every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_pairs(texts: list[bytes | None], hashes: _WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token << 16 | place of the text), sorted and distinct; set size and
    class of each text."""
    parts, places, sizes, classes = [], [], [], []
    for raw in texts:
        words = raw.lower().split() if raw else []  # both touch ASCII only
        classes.append(int.from_bytes(hashlib.blake2b(b" ".join(words), digest_size=8).digest(), "little", signed=True))
        sizes.append(len(words))
    first: dict[int, int] = {}
    for i, c in enumerate(classes):
        first.setdefault(c, i)
    for i in first.values():
        if not sizes[i]:
            continue
        words = texts[i].lower().split()
        h = np.zeros(max(len(words), WORDS), dtype=np.uint64)  # 0 pads a short text
        h[:len(words)] = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
        parts.append(h)
        places.append(i)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64), np.array(classes, dtype=np.int64)
    n = np.array([len(p) for p in parts])
    h = np.concatenate(parts)
    token = h[:len(h) - WORDS + 1].copy()
    for k in range(1, WORDS):
        token = _mix(token + np.uint64(0x9E3779B97F4A7C15)) + h[k:len(h) - WORDS + 1 + k]
    token = _mix(token) >> np.uint64(64 - TOKEN_BITS)
    place = np.repeat(np.array(places, dtype=np.uint64), n)[:len(token)]
    ends = np.cumsum(n)
    inside = np.ones(len(token), dtype=bool)  # a shingle lies in one text
    for k in range(1, WORDS):
        at = ends[:-1] - k
        inside[at] = False
    pairs = np.sort((token[inside] << np.uint64(INDEX_BITS)) | place[inside])
    pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])]
    size = np.bincount((pairs & _MASK).astype(np.int64), minlength=len(texts))
    of_class = np.array([first[c] for c in classes])
    return pairs, size[of_class], np.array(classes, dtype=np.int64)


def _pack(values: np.ndarray) -> bytes:
    """Unsigned integers in as few bytes each as the largest needs, by byte plane."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + planes.tobytes()


def _unpack(blob: bytes) -> np.ndarray:
    width, n = blob[0], (len(blob) - 1) // blob[0]
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(blob, dtype=np.uint8, offset=1).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=np.uint64(0)))


def _unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(_unpack(blob), dtype=np.uint64)


def _i64(values) -> bytes:
    return np.asarray(values, dtype="<i8").tobytes()


def _from_i64(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype="<i8")


_PACKED = "bucket bigint, kind int, a binary, b binary, c binary"


def _rows(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [[]] * 5
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(("bucket", "kind", "a", "b", "c"), cols, kinds)})


def _home(classes: np.ndarray, homes: int) -> np.ndarray:
    return (_mix(classes.astype(np.uint64)) % np.uint64(homes)).astype(np.int64)


def _split(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    at = np.searchsorted(keys[order], np.arange(buckets + 1))
    return ((d, order[i:j]) for d, (i, j) in enumerate(zip(at, at[1:])) if j > i)


def _split_far(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """As ``_split``, for a few of very many buckets."""
    order = np.argsort(keys, kind="stable")
    found, at = np.unique(keys[order], return_index=True)
    return ((int(d), order[i:j]) for d, i, j in zip(found, at, np.append(at[1:], len(order))))


class _Layout(NamedTuple):
    """Where rows go: ``homes`` of classes, ``buckets`` token ranges; beyond
    one ``step`` they go by ``step`` ranges first, in ``salts`` groups each."""

    homes: int
    buckets: int
    step: int = 1
    salts: int = 1

    def bounds(self, step: int = 1) -> list[int]:
        return [(min(i, self.buckets) << TOKEN_BITS) // self.buckets for i in range(0, self.buckets + step, step)]

    def key(self, bucket: int, salt: int) -> int:
        """Group of the first step that a bucket's rows of one sender go to."""
        return bucket if self.step == 1 else bucket // self.step * self.salts + salt % self.salts

    def first(self, key: int) -> int:
        """First bucket of a group's step."""
        return key // self.salts * self.step

    def pick(self, first: int, classes: bytes) -> int:
        """Any home of a step."""
        return first + int(_mix(np.frombuffer(classes, dtype="<u8", count=1))[0]) % min(self.step, self.homes - first)


def layout(text_bytes: int, least: int) -> _Layout:
    homes = max(least, -(-text_bytes // HOME_BYTES))
    if homes <= FAN:
        return _Layout(homes, 4 * homes)
    buckets = 4 * homes
    coarse = math.isqrt(buckets) + 1
    step = -(-buckets // coarse)
    return _Layout(homes, buckets, step, max(1, -(-text_bytes // (GROUP_BYTES * -(-homes // step)))))


def _by_range(token: np.ndarray, place: np.ndarray, classes: np.ndarray, bounds: list[int]) -> Iterator[tuple]:
    """(range, packed tokens, places, classes) of sorted tokens."""
    at = np.searchsorted(token, np.array(bounds, dtype=np.uint64))
    present = np.zeros(len(classes), dtype=bool)
    for d, (i, j) in enumerate(zip(at, at[1:])):
        if j > i:
            here = place[i:j]
            present[:] = False
            present[here] = True
            local = (np.cumsum(present) - 1)[here].astype(np.uint64)
            yield d, _pack_sorted(token[i:j] - np.uint64(bounds[d])), _pack(local), _i64(classes[present])


def _deal(to: _Layout):
    """Map side: a slice of documents becomes packed rows, dealt to token
    ranges; what belongs to documents and classes is passed on to its home."""
    bounds = to.bounds(to.step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for b in in_slices(batches, "text", SLICE_BYTES, SLICE_DOCS):
            pairs, size, classes = shingle_pairs(utf8_values(b.column("text")), hashes)
            ids = b.column("doc_id").to_pylist()
            known = np.array([x is not None for x in ids])
            ids = np.array([x or 0 for x in ids], dtype=np.int64)
            salt = int(_mix(classes.astype(np.uint64).sum(keepdims=True))[0])
            turn = salt % to.homes  # rows of documents are only passed on: any home does
            rows = [(to.key(turn, salt), META, _i64(ids), _i64(classes), _i64(size * 2 + known))]
            unique, start, inverse = np.unique(classes, return_index=True, return_inverse=True)
            smallest = np.full(len(unique), 2 ** 63 - 1)
            np.minimum.at(smallest, inverse[known], ids[known])
            for d, k in _split(_home(unique, to.homes) // to.step, -(-to.homes // to.step)):
                rows.append((to.key(d * to.step, salt), CLASS, _i64(unique[k]), _i64(size[start[k]]), _i64(smallest[k])))
            token, place = pairs >> np.uint64(INDEX_BITS), (pairs & _MASK).astype(np.int64)
            rows += [(to.key(d * to.step, salt), TOKENS, *packed) for d, *packed in _by_range(token, place, classes, bounds)]
            yield from _rows(rows).to_batches()
    return run


def _united(kind: np.ndarray, a: list, b: list, c: list) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Distinct (token, place in classes) of a range's rows, sorted; the classes."""
    mine = np.flatnonzero(kind == TOKENS)
    if not len(mine):
        return None
    tables = [np.frombuffer(c[i], dtype="<i8") for i in mine]
    classes, dense = np.unique(np.concatenate(tables), return_inverse=True)
    shift = np.concatenate([[0], np.cumsum([len(x) for x in tables])])
    token = np.concatenate([_unpack_sorted(a[i]) for i in mine])
    who = np.concatenate([dense[s + _unpack(b[i]).astype(np.int64)] for s, i in zip(shift, mine)])
    bits = int(len(classes)).bit_length()
    if int(token.max()).bit_length() + bits <= 64:
        both = np.sort(token << np.uint64(bits) | who.astype(np.uint64))
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
        return both >> np.uint64(bits), (both & np.uint64((1 << bits) - 1)).astype(np.int64), classes
    order = np.lexsort((who, token))
    token, who = token[order], who[order]
    fresh = np.concatenate([[True], (token[1:] != token[:-1]) | (who[1:] != who[:-1])])
    return token[fresh], who[fresh], classes


def _class_rows(kind: np.ndarray, a: list, b: list, c: list, homes: int) -> Iterator[tuple]:
    """The class rows of a group, dealt to their homes."""
    mine = np.flatnonzero(kind == CLASS)
    if len(mine):
        cls, n, rep = (_from_i64([x[i] for i in mine]) for x in (a, b, c))
        for d, k in _split_far(_home(cls, homes)):
            yield d, CLASS, _i64(cls[k]), _i64(n[k]), _i64(rep[k])


def _to_ranges(to: _Layout):
    """Second step to the ranges: slices' rows of some ranges, united, go on
    to each of them."""
    def run(t: pa.Table) -> pa.Table:
        kind = np.array(t.column("kind").to_pylist())
        a, b, c = (t.column(x).to_pylist() for x in "abc")
        first = to.first(t.column("bucket")[0].as_py())
        out = [(to.pick(first, b[i]), META, a[i], b[i], c[i]) for i in np.flatnonzero(kind == META)]
        out += _class_rows(kind, a, b, c, to.homes)
        found = _united(kind, a, b, c)
        if found:
            token, who, classes = found
            bounds = to.bounds()[first:first + to.step + 1]
            out += [(first + d, TOKENS, *packed)
                    for d, *packed in _by_range(token + np.uint64(bounds[0]), who, classes, bounds)]
        return _rows(out)
    return run


def _to_homes(to: _Layout):
    """Second step to the homes: counted tokens of some homes' classes."""
    def run(t: pa.Table) -> pa.Table:
        kind = np.array(t.column("kind").to_pylist())
        a, b, c = (t.column(x).to_pylist() for x in "abc")
        first = to.first(t.column("bucket")[0].as_py())
        out = [(to.pick(first, b[i]), META, a[i], b[i], c[i]) for i in np.flatnonzero(kind == META)]
        out += _class_rows(kind, a, b, c, to.homes)
        if (kind == TOKENS).any():
            owner, token, df = _counted(kind, a, b, c)
            for d, k in _split_far(_home(owner, to.homes)):
                out.append(_home_row(d, owner[k], token[k], df[k]))
        return _rows(out)
    return run


def _counted(kind: np.ndarray, a: list, b: list, c: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, token, frequency) of the rows that ranges sent."""
    mine = np.flatnonzero(kind == TOKENS)
    heads = [np.frombuffer(a[i], dtype="<i8").reshape(2, -1) for i in mine]
    return (np.concatenate([np.repeat(h[0], h[1]) for h in heads]), np.concatenate([_unpack(b[i]) for i in mine]),
            np.concatenate([_unpack(c[i]) for i in mine]))


def _home_row(bucket: int, owner: np.ndarray, token: np.ndarray, df: np.ndarray) -> tuple:
    k = np.argsort(owner, kind="stable")
    cls, n = np.unique(owner[k], return_counts=True)
    return bucket, TOKENS, _i64(cls) + _i64(n), _pack(token[k]), _pack(df[k].astype(np.uint64))


def _count(to: _Layout):
    """One token range: the tokens of two or more classes go back to them."""
    def run(t: pa.Table) -> pa.Table:
        kind = np.array(t.column("kind").to_pylist())
        a, b, c = (t.column(x).to_pylist() for x in "abc")
        bucket = t.column("bucket")[0].as_py()
        out = [(to.key(bucket, bucket), int(kind[i]), a[i], b[i], c[i]) for i in np.flatnonzero(kind != TOKENS)]
        found = _united(kind, a, b, c)
        if found:
            token, who, classes = found
            start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            df = np.diff(np.append(start, len(token)))
            shared = np.repeat(df > 1, df)
            token, who, df = token[shared], who[shared], np.repeat(df, df)[shared]
            token = token + np.uint64((bucket << TOKEN_BITS) // to.buckets)
            for d, k in _split(_home(classes, to.homes)[who] // to.step, -(-to.homes // to.step)):
                out.append(_home_row(to.key(d * to.step, bucket), classes[who[k]], token[k], df[k]))
        return _rows(out)
    return run


_SETS = ("doc_id bigint, class bigint, n bigint, rep bigint, unshared bigint, prefix array<bigint>, tokens binary")


def needed(n: np.ndarray) -> np.ndarray:
    """Smallest overlap with itself that a set of n tokens must keep."""
    return (NEED * n + 99) // 100


def _prefixes(t: pa.Table) -> pa.Table:
    """One home of classes: their rows, and the prefixes of their sets."""
    kind = np.array(t.column("kind").to_pylist())
    a, b, c = (t.column(x).to_pylist() for x in "abc")
    pick = lambda k: np.flatnonzero(kind == k)
    ids, of, size = (_from_i64([x[i] for i in pick(META)]) for x in (a, b, c))
    size, known = size >> 1, (size & 1).astype(bool)
    cls, n, rep = (_from_i64([x[i] for i in pick(CLASS)]) for x in (a, b, c))
    cls, start, inverse = np.unique(cls, return_index=True, return_inverse=True)
    smallest = np.full(len(cls), 2 ** 63 - 1)
    np.minimum.at(smallest, inverse, rep)
    n = n[start]
    unshared, prefix, blob = [None] * len(cls), [None] * len(cls), [None] * len(cls)
    if (kind == TOKENS).any():
        owner, token, df = _counted(kind, a, b, c)
        at = np.searchsorted(cls, owner)
        order = np.lexsort((token, df, at))
        at, token = at[order], token[order]
        begin = np.searchsorted(at, np.arange(len(cls)))
        end = np.append(begin[1:], len(at))
        lone = n - (end - begin)
        length = n - needed(n) + 1
        for k in np.flatnonzero((end > begin) & (length > lone)).tolist():
            own = token[begin[k]:end[k]]
            unshared[k] = int(lone[k])
            prefix[k] = own[:length[k] - lone[k]].astype(np.int64)
            blob[k] = _pack_sorted(np.sort(own))
    m, k = len(ids), len(cls)
    null = lambda size, kind: pa.nulls(size, kind)
    return pa.table({
        "doc_id": pa.concat_arrays([pa.array(ids, mask=~known), null(k, pa.int64())]),
        "class": pa.array(np.concatenate([of, cls])), "n": pa.array(np.concatenate([size, n])),
        "rep": pa.concat_arrays([null(m, pa.int64()), pa.array(smallest)]),
        "unshared": pa.array([None] * m + unshared, pa.int64()),
        "prefix": pa.array([None] * m + prefix, pa.list_(pa.int64())),
        "tokens": pa.array([None] * m + blob, pa.binary())})


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets overlap enough."""
    for batch in in_slices(batches, "tokens_b", max_rows=4096):
        cols = [batch.column(x).to_pylist() for x in ("a", "b", "n_a", "n_b", "tokens_a", "tokens_b")]
        links, last, x = [], None, None
        for a, b, na, nb, ta, tb in zip(*cols):
            if a != last:
                last, x = a, _unpack_sorted(ta)
            y = _unpack_sorted(tb)
            # |x and y| >= 0.8 |x or y|  <=>  180 * overlap >= 80 * (na + nb)
            least = -(-NEED * (na + nb) // (100 + NEED))
            if min(len(x), len(y)) < least:
                continue
            pivots = y[len(y) // 8::len(y) // 8 + 1]  # suffix filter: parts between pivots bound the overlap
            cx, cy = np.searchsorted(x, pivots), np.searchsorted(y, pivots)
            if np.minimum(np.diff(cx, prepend=0, append=len(x)), np.diff(cy, prepend=0, append=len(y))).sum() < least:
                continue
            at = np.searchsorted(x, y)
            if int((x[np.minimum(at, len(x) - 1)] == y).sum()) >= least:
                links.append((a, b))
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Verified links among candidate ``pairs`` (a, b, n_a, n_b)."""
    side = lambda x: sets.select(F.col("class").alias(x), F.col("tokens").alias(f"tokens_{x}"))
    return cut(pairs.join(side("b"), "b").join(side("a"), "a")
               .select("a", "b", "n_a", "n_b", "tokens_a", "tokens_b").mapInArrow(_verify, "a bigint, b bigint"), "ngram-links")


def _may_link(x: str, y: str) -> F.Column:
    """Length filter and positional filter for a token that two sets share.

    A linked pair is met at the first token that it shares: none comes
    before it in either set, so the overlap is at most what follows there."""
    nx, ny, px, py = f"n_{x}", f"n_{y}", f"place_{x}", f"place_{y}"
    least = f"ceil({NEED} * ({nx} + {ny}) / {100 + NEED})"
    return F.expr(f"100 * least({nx}, {ny}) >= {NEED} * greatest({nx}, {ny}) "
                  f"and least({nx} - {px}, {ny} - {py}) >= {least}")


def _connected(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) of the known components after ``links`` (a, b) are added.

    Links are taken between the components' names, so that only what a round
    adds is followed."""
    if roots is None:
        return components(links, "ngram-roots")
    if links.isEmpty():
        return roots
    name = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
    between = (links.join(name("a"), "a", "left").join(name("b"), "b", "left")
               .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).where("a <> b").distinct())
    new = components(between, "ngram-joined")
    moved = roots.join(new.select(F.col("node").alias("root"), F.col("root").alias("next")), "root", "left")
    return cut(moved.select("node", F.coalesce("next", "root").alias("root"))
               .unionByName(new.join(roots, "node", "left_anti")), "ngram-roots")


def _rest_pairs(rest: DataFrame) -> DataFrame:
    """Candidate pairs (a, b, n_a, n_b) of different components in lists
    (token, b, n_b, place_b, root_b): of each pair that shares a token and
    passes ``_may_link``, one row per token.

    Both filters hold exactly where n_a <= top_b and n_b <= top_a."""
    band = lambda n: F.floor(F.log(n) / F.lit(math.log(BAND)))
    rest = rest.withColumn("top_b", F.expr("floor((5 * n_b - 9 * place_b) / 4)"))
    large = rest.withColumn("band", band(F.col("n_b")))
    small = (rest.where("top_b >= n_b").select("token", *[F.col(f"{c}b").alias(f"{c}a") for c in ("", "n_", "top_", "root_")])
             .withColumn("band", F.explode(F.sequence(band(F.col("n_a")), band(F.col("top_a"))))))
    blocks = lambda df, name: df.groupBy("token", "band").agg(F.ceil(F.count("*") / BLOCK).alias(name))
    sizes = cut(blocks(small, "of_a").join(blocks(large, "of_b"), ["token", "band"]), "ngram-blocks")

    def dealt(df: DataFrame, x: str, other: str) -> DataFrame:
        return (df.join(sizes, ["token", "band"]).withColumn(f"at_{x}", F.expr(f"pmod(xxhash64({x}), of_{x})"))
                .withColumn(f"at_{other}", F.explode(F.expr(f"sequence(0L, of_{other} - 1)"))).drop("of_a", "of_b"))
    return (dealt(small, "a", "b").join(dealt(large, "b", "a"), ["token", "band", "at_a", "at_b"])
            .where("root_a <> root_b and n_a <= top_b and n_b <= top_a and (n_a < n_b or n_a = n_b and a < b)")
            .select("a", "b", "n_a", "n_b"))


def ngram_groups(docs: DataFrame, homes: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs``.

    Homes part the classes, four times as many ranges part the tokens.  There
    are as many as the bytes of all texts ask for, and at least ``homes``
    (default: one per shuffle partition)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    text_bytes = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    to = layout(text_bytes, homes or int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = rows.mapInArrow(_deal(to), _PACKED)
    if to.step > 1:
        packed = packed.groupBy("bucket").applyInArrow(_to_ranges(to), _PACKED)
    packed = packed.groupBy("bucket").applyInArrow(_count(to), _PACKED)
    if to.step > 1:
        packed = packed.groupBy("bucket").applyInArrow(_to_homes(to), _PACKED)
    found = cut(packed.groupBy("bucket").applyInArrow(_prefixes, _SETS), "ngram-sets")
    members = found.where("rep is null").select("doc_id", "class", "n")
    classes = found.where("rep is not null").select("class", "n", "rep")
    sets = found.where("tokens is not null").select("class", "n", "tokens")
    index = (found.where("prefix is not null")
             .select("class", "n", "unshared", F.posexplode("prefix").alias("k", "token"))
             .select("token", F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("unshared").alias("unshared_b"),
                     (F.col("unshared") + F.col("k")).alias("place_b"), F.col("class").alias("root_b")))
    part = F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int")
    roots, rounds, before = None, 0, 0
    while True:
        stars = cut(index.groupBy("token").agg(
            F.min(F.struct("unshared_b", "b", "n_b", "place_b", "root_b")).alias("head"),
            F.min("root_b").alias("least"), F.max("root_b").alias("last"), F.count("*").alias("members"),
            F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(b), {SALTS}) as int))")).alias("parts")).where("least < last")
            .select("token", *[F.col(f"head.{c}_b").alias(f"{c}_a") for c in ("unshared", "n", "place", "root")],
                    F.col("head.b").alias("a"), "members", "parts"), "ngram-stars")
        still = stars.agg(F.sum("members")).first()[0]
        if not still:
            break
        if rounds >= STARS and 2 * still > before:
            rest = cut(index.join(stars.select("token"), "token").select("token", "b", "n_b", "place_b", "root_b"), "ngram-rest")
            roots = _connected(roots, _links(cut(_rest_pairs(rest).distinct(), "ngram-pairs"), sets))
            break
        centres = (stars.withColumn("part", F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), i -> (parts & shiftleft(1L, i)) <> 0)")))
                   .drop("members", "parts"))
        index = cut(index.withColumn("part", part).join(centres, ["token", "part"]).where("b <> a").drop("part"), "ngram-open")
        pairs = cut(index.where("root_b <> root_a").where(_may_link("a", "b"))
                    .select("a", "b", "n_a", "n_b").distinct(), "ngram-pairs")
        roots = _connected(roots, _links(pairs, sets))
        index = (index.select("token", "b", "n_b", "unshared_b", "place_b")
                 .join(roots.withColumnRenamed("node", "b"), "b", "left")
                 .select("token", "b", "n_b", "unshared_b", "place_b", F.coalesce("root", "b").alias("root_b")))
        rounds, before = rounds + 1, still
    if roots is None:
        named = classes.select("class", F.col("rep").alias("component"))
    else:
        rooted = cut(classes.join(roots.withColumnRenamed("node", "class"), "class", "left")
                     .select("class", "rep", F.coalesce("root", "class").alias("root")), "ngram-rooted")
        names = cut(rooted.groupBy("root").agg(F.min("rep").alias("component")), "ngram-names")
        named = cut(rooted.join(names, "root").select("class", "component"), "ngram-named")
    return members.join(named, "class").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("component") < 2 ** 63 - 1, F.col("component"))
        .alias("component_id"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component left, the one that names
    it (documents without an id stay only where nothing else is in their
    component); columns unchanged."""
    groups = ngram_groups(docs)
    keep = cut(groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(id_key().alias("keep_key")).distinct(),
               "ngram-kept")
    return docs.join(keep.hint("shuffle_hash"), id_key() == keep["keep_key"], "left_semi")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` with its set size and component."""
    return ngram_groups(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[j:j + 4], ' ') AS sh
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS j) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
df AS (SELECT sh FROM s GROUP BY sh HAVING count(*) > 1),
shared AS (SELECT doc_id, sh FROM s JOIN df USING (sh)),
links AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_have
    FROM shared x JOIN shared y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * both_have >= 80 * (na.n + nb.n - both_have)),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM n
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node) c USING (doc_id)
"""
