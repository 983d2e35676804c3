"""A hierarchical Pitman-Yor language model of words, and its scores.

Restaurants: every two preceding words have one, whose parent is the
restaurant of the preceding word alone, whose parent is the root, above which
is the uniform distribution over the vocabulary and one unknown word. Before
a text's first word stand two start words. Customers of a restaurant are the
words seen in its context; its tables are customers of its parent. Seating is
sampled by Gibbs: in a sweep, all customers of a (restaurant, word) leave and
are seated again given the parent's probability and the restaurant's totals,
at each level in turn. Up to EXACT customers the number of tables comes from
its exact conditional by generalised Stirling numbers, beyond that customers
come in blocks that grow by an eighth. Discounts come from the counts of words
seen once and twice. The predictive probabilities of the last sweeps are
averaged.

A bucket holds a range of hashes of the preceding word: the restaurants of
that word and of all word pairs that end in it, so sweeps need nothing from
other buckets but the root's probabilities of their words. After each round
the tables of each word go from the buckets to the root, which is dealt by
ranges of the word's hash, seated there and sent back; sums of five numbers
reach the driver. The number of buckets follows the number of tokens, that of
restaurants the contexts in the text. Word triples of texts that are only
scored are counted with no customer, so that their probabilities need no
separate search. Triples travel once, as compressed blobs, a row per (chunk of
documents, bucket), summed within a chunk. They are stored by bucket, merged,
and beside them a piece for each chunk says which of them its tokens are and
in which documents they stand, so that scoring neither reads the texts again
nor sends the words of a chunk a second time. All rounds and the scoring
read them where they lie. A frequent word makes its bucket
large: it is stored and scored in several groups of chunks, each with a copy of
the bucket's counts; the sampler's seed depends on the bucket alone, so the
copies agree.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelsmith.llm import words as W
from panelsmith.session import bucketed_table, cut_lineage, drop_table

ROUNDS, SWEEPS, BURN_IN = 3, 5, 2
EXACT = 32
#: Tokens of a chunk of documents, and of a bucket on average.
CHUNK_TOKENS = 1_000_000
BUCKET_TOKENS = 1_000_000
#: Buckets' ranges that one task of the root has, and buckets that one task
#: samples, on average.
ROOT_BUCKETS, TASK_BUCKETS = 16, 4
#: Scores travel as whole multiples of 2**-SCORE_BITS.
SCORE_BITS = 32
#: Bytes of blobs merged and scored in one group of chunks.
GROUP_BYTES = 48_000_000
_ZERO, _END, _START = np.uint64(0), np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)


# ------------------------------------------------------------------- blobs


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one blob; their numbers' first bytes, second bytes and so on
    stand together, which compresses better, up to the largest number's last."""
    widths = [_width(a) for a in arrays]
    head = np.array([len(arrays), *[len(a) for a in arrays], *widths], dtype=np.int64).tobytes()
    raw = head + b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize)[:, :k].T.tobytes() for a, k in zip(arrays, widths))
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _width(a: np.ndarray) -> int:
    """Bytes that the numbers of an array need."""
    if a.dtype.kind != "u" or not len(a):
        return a.dtype.itemsize
    return max(1, (int(a.max()).bit_length() + 7) // 8)


def unpack(blob: bytes | pa.Buffer, *kinds: str) -> list[np.ndarray]:
    blob = memoryview(blob)
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    head = np.frombuffer(raw, dtype=np.int64, count=2 * len(kinds) + 1)[1:].tolist()
    out, at = [], 8 * (2 * len(kinds) + 1)
    for kind, n, k in zip(kinds, head, head[len(kinds) :]):
        whole = np.zeros((n, np.dtype(kind).itemsize), dtype=np.uint8)
        whole[:, :k] = np.frombuffer(raw, dtype=np.uint8, count=n * k, offset=at).reshape(k, n).T
        out.append(whole.reshape(-1).view(kind))
        at += n * k
    return out


#: Words that blobs name by a number, and texts they are taken from.
CODED, CODED_FROM = 1 << 17, 3_000_000
#: The words of a blob, and triples of their places: previous word, the one
#: before, word; then training customers.
COUNTS = ("u8", "u4", "u4", "u4", "u4")
#: The same in steps: between the numbers of words that have one, between the
#: other words, from one triple's previous word to the next one's, and between
#: the words before of one previous word.
CODED_COUNTS = ("u4", *COUNTS)
#: With the tokens and the tokens' documents.
TOKENS = (*CODED_COUNTS, "u4", "u4")
#: Steps from one triple of a chunk to the next, tokens, the tokens' documents.
PIECE = ("u4", "u4", "u4")


def _is_first(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the one before."""
    out = np.ones(len(columns[0]), dtype=bool)
    out[1:] = columns[0][1:] != columns[0][:-1]
    for c in columns[1:]:
        out[1:] |= c[1:] != c[:-1]
    return out


def _sum_pairs(words, contexts, n):
    order = np.lexsort((contexts, words))
    words, contexts, n = words[order], contexts[order], n[order]
    if not len(words):
        return words, contexts, n
    at = np.flatnonzero(_is_first(words, contexts))
    return words[at], contexts[at], np.add.reduceat(n, at)


def _triple_order(v, x, w, size: int) -> np.ndarray:
    """Order of triples of numbers below ``size``, that of equal ones any."""
    if size <= 1 << 21:
        return np.argsort((v.astype(np.int64) << 42) | (x.astype(np.int64) << 21) | w.astype(np.int64))
    return np.lexsort((w, x, v))


def pack_triples(words, v, x, w, *rest, coded: np.ndarray | None = None, numbers=None) -> bytes:
    """A blob with those of the sorted ``words`` that its triples need. With
    sorted ``coded`` words it has their numbers (``numbers``: ``words`` looked
    up among them, if that is done) and steps, see CODED_COUNTS."""
    used = np.zeros(len(words), dtype=bool)
    for column in (v, x, w):
        used[column] = True
    used = np.flatnonzero(used)
    place = np.empty(len(words), dtype=np.uint32)
    place[used] = np.arange(len(used), dtype=np.uint32)
    own, v, x, w = words[used], *[place[c] for c in (v, x, w)]
    rest = [c.astype("u4") for c in rest]
    if coded is None:
        return pack(own, v, x, w, *rest)
    at, known = (c[used] for c in (lookup(coded, words) if numbers is None else numbers))
    x_steps = np.where(_is_first(v), x, np.diff(x, prepend=x[:1]))
    return pack(np.diff(at[known], prepend=0).astype("u4"), np.diff(own[~known], prepend=_ZERO), np.diff(v, prepend=v.dtype.type(0)), x_steps, w, *rest)


def unpack_tokens(blob: bytes | pa.Buffer, coded: np.ndarray, kinds: tuple = TOKENS) -> list[np.ndarray]:
    """The columns of a blob with ``coded`` words, COUNTS first."""
    numbers, own, v, x, *rest = unpack(blob, *kinds)
    v, x = np.cumsum(v, dtype="u4"), np.cumsum(x, dtype="u4")  # modulo 2**32
    first = np.flatnonzero(_is_first(v))
    before = np.append(x.dtype.type(0), x)[first]
    x -= np.repeat(before, np.diff(first, append=len(v)))
    return [np.sort(np.concatenate([coded[np.cumsum(numbers)], np.cumsum(own, dtype="u8")])), v, x, *rest]


def merge_triples(parts: list) -> tuple[tuple[np.ndarray, ...], list[np.ndarray]]:
    """(words, v, x, w, n) of all parts: sorted words, and triples of their
    places, sorted, with the sums of their customers. Also the places of each
    part's triples among them, which rise as the part's do."""
    if len(parts) == 1:
        return tuple(parts[0][:5]), [np.arange(len(parts[0][1]))]
    words, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    at = at.astype(np.uint32)
    ends = np.cumsum([0, *[len(p[0]) for p in parts]]).tolist()
    v, x, w = (np.concatenate([at[a:b][p[k]] for p, a, b in zip(parts, ends, ends[1:])]) for k in (1, 2, 3))
    order = _triple_order(v, x, w, len(words))
    v, x, w = v[order], x[order], w[order]
    is_first = _is_first(v, x, w)
    first, place = np.flatnonzero(is_first), np.empty(len(v), dtype=np.uint32)
    place[order] = np.cumsum(is_first) - 1
    n = np.concatenate([p[4] for p in parts])[order]
    merged = words, v[first], x[first], w[first], np.add.reduceat(n, first, dtype=np.int64)
    return merged, np.split(place, np.cumsum([len(p[1]) for p in parts])[:-1])


def merge_counts(blobs: list, coded: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(words, v, x, w, n) of all blobs, see ``merge_triples``."""
    return merge_triples([unpack(b, *COUNTS) if coded is None else unpack_tokens(b, coded, CODED_COUNTS) for b in blobs])[0]


# ------------------------------------------------------------------ sampler


def log_stirling(d: float, n: int = EXACT) -> np.ndarray:
    """log of the generalised Stirling numbers S_d(c, t) for c, t up to n."""
    table = np.full((n + 1, n + 1), -np.inf)
    table[0, 0] = 0.0
    for c in range(1, n + 1):
        for t in range(1, c + 1):
            stay = np.log(c - 1 - d * t) + table[c - 1, t] if c - 1 - d * t > 0 else -np.inf
            table[c, t] = np.logaddexp(table[c - 1, t - 1], stay)
    return table


def seat(customers: np.ndarray, weight: np.ndarray, d: float, stirling: np.ndarray, rng) -> np.ndarray:
    """Tables sampled for each (restaurant, word): ``customers`` of them, with
    ``weight`` = (strength + discount * tables) * parent probability of a new
    table, the restaurant's totals held."""
    tables = np.minimum(customers, 1)
    several = np.flatnonzero(customers > 1)
    first = np.minimum(customers[several], EXACT).astype(np.uint8)
    several, ends = several[np.argsort(first, kind="stable")], np.cumsum(np.bincount(first, minlength=EXACT + 1))
    for c in range(2, EXACT + 1):
        at = several[ends[c - 1] : ends[c]]
        if len(at):
            t = np.arange(1, c + 1)[:, None]
            p = stirling[c, 1 : c + 1, None] + t * np.log(weight[at])
            p = np.cumsum(np.exp(p - p.max(axis=0)), axis=0)
            tables[at] = 1 + (p < rng.random(len(at)) * p[-1]).sum(axis=0)
    at, seated = np.flatnonzero(customers > EXACT), EXACT
    while len(at):
        block = np.minimum(max(1, seated // 8), customers[at] - seated)
        p = weight[at] / (weight[at] + seated - d * tables[at])
        tables[at] = tables[at] + rng.binomial(block, np.clip(p, 0, 1))
        seated += max(1, seated // 8)
        at = at[customers[at] > seated]
    return tables


class Totals:
    """Customers and tables of the root, discounts and strengths."""

    def __init__(self, rows: dict[tuple[int, int], tuple[float, float]], sizes: dict[int, tuple[float, float]], vocabulary: int):
        self.n, self.t = rows.get((0, 0), (0.0, 0.0))
        # the usual estimate of a discount, kept inside (0, 1)
        self.d = [float(np.clip(one / max(one + 2 * two, 1), 0.05, 0.95)) for one, two in (sizes.get(k, (0.0, 0.0)) for k in range(3))]
        self.strength = [1.0, 1.0, 1.0]
        self.vocabulary = vocabulary

    def new_word(self) -> float:
        """Weight of a new table of the root."""
        return (self.strength[0] + self.d[0] * self.t) / (self.vocabulary + 1)

    def root(self, n: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Probability of words with n customers at t tables of the root."""
        return (n - self.d[0] * t + self.new_word()) / (self.n + self.strength[0])


class Seating:
    """The sampled state of one bucket: the levels ``word``, ``group`` (a word
    after a parent context) and ``pair`` (a word after a context). A context
    has one parent; without ``parents`` that is the empty context."""

    def __init__(self, words, contexts, n, parents=None):
        parents = np.zeros(len(words), dtype=np.int64) if parents is None else parents
        unique, w = np.unique(words, return_inverse=True)
        self.contexts, c = np.unique(contexts, return_inverse=True)
        self.parents, p = np.unique(parents, return_inverse=True)
        order = np.lexsort((w, c))
        self._build(unique, p[order], c[order], w[order], np.asarray(n)[order])

    @classmethod
    def of(cls, words, v, x, w, n) -> Seating:
        """From ``merge_counts``: contexts are (v, x), parents v."""
        self = cls.__new__(cls)
        is_context, is_parent = _is_first(v, x), _is_first(v)
        self.contexts, self.parents = v[is_context].astype(np.int64) * len(words) + x[is_context], v[is_parent].astype(np.int64)
        self._build(words, np.cumsum(is_parent) - 1, np.cumsum(is_context) - 1, w, n)
        return self

    def _build(self, words, p, c, w, n):
        # arrays by triple and group have four bytes a number, as in the blobs
        self.words, self.n, self.context = words, n.astype(np.uint32), c.astype(np.uint32)
        self.parent_of_context = np.zeros(len(self.contexts), dtype=np.int64)
        self.parent_of_context[c] = p
        groups, group_of = np.unique(p * len(words) + w, return_inverse=True)
        self.parent, self.word = (k.astype(np.uint32) for k in np.divmod(groups, max(len(words), 1)))
        self.group_of, c = group_of.astype(np.uint32), self.context
        del groups, group_of, p
        self.first_of_parent = np.flatnonzero(_is_first(self.parent))
        self.raw = self._sum(w, self.n, len(words))
        first = np.flatnonzero(_is_first(c))
        self.context_n = np.add.reduceat(self.n, first, dtype=np.int64)
        # only these have a choice of tables
        self.open = np.flatnonzero(self.n > 1)
        self.open_context, self.open_group = c[self.open], self.group_of[self.open]
        self.t = np.minimum(self.n, 1)
        self.closed_context_t = np.add.reduceat(self.n == 1, first, dtype=np.int64)
        self.closed_group_n = self._sum(self.group_of, self.n == 1, len(self.word)).astype(np.uint32)
        self._up()
        self.gt = np.minimum(self.gn, 1)
        self.wn = self._sum(self.word, self.gt, len(words))
        self.wt = np.minimum(self.wn, 1)

    @property
    def groups(self) -> np.ndarray:
        """Parent and word of each group as one number."""
        return self.parent.astype(np.int64) * len(self.words) + self.word

    @property
    def pairs(self) -> np.ndarray:
        """Context and word of each pair as one number."""
        return self.context.astype(np.int64) * len(self.words) + self.word[self.group_of]

    @staticmethod
    def _sum(where, weights, size) -> np.ndarray:
        return np.bincount(where, weights=weights, minlength=size).astype(np.int64)

    def _up(self):
        t = self.t[self.open]
        self.context_t = self.closed_context_t + self._sum(self.open_context, t, len(self.contexts))
        self.gn = self.closed_group_n + self._sum(self.open_group, t, len(self.word)).astype(np.uint32)

    def _of_parents(self) -> tuple[np.ndarray, np.ndarray]:
        """Customers and tables of each parent's restaurant."""
        n, t = (np.add.reduceat(k, self.first_of_parent, dtype=np.int64) for k in (self.gn, self.gt))
        return n, t

    def _group(self, m: Totals, at_root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight of a new table, and probability, of each group's word, whose
        probability at the root is given."""
        parent_n, parent_t = self._of_parents()
        new = (m.strength[1] + m.d[1] * parent_t)[self.parent] * at_root
        return new, (self.gn - m.d[1] * self.gt + new) / (parent_n + m.strength[1])[self.parent]

    def _fresh(self, m: Totals) -> np.ndarray:
        return m.strength[2] + m.d[2] * self.context_t

    def predict(self, m: Totals, root: np.ndarray | None = None, at_root: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of each word at the root, group and pair; ``root`` is
        given where the root is seated elsewhere, ``at_root`` the same by group."""
        root = m.root(self.wn, self.wt) if root is None else root
        _, group = self._group(m, root[self.word] if at_root is None else at_root)
        pair = group[self.group_of]
        pair *= self._fresh(m)[self.context]
        pair += self.n - m.d[2] * self.t
        pair /= (self.context_n + m.strength[2])[self.context]
        return root, group, pair

    def sweep(self, m: Totals, stirling: list[np.ndarray], rng, at_root: np.ndarray | None = None) -> None:
        """Seat all again, the root, too, if its probabilities are not given by
        group."""
        seated = at_root is None
        new, group = self._group(m, m.root(self.wn, self.wt)[self.word] if seated else at_root)
        weight = self._fresh(m)[self.open_context] * group[self.open_group]
        self.t[self.open] = seat(self.n[self.open], weight, m.d[2], stirling[2], rng)
        self._up()
        self.gt = seat(self.gn, new, m.d[1], stirling[1], rng)
        if seated:
            self.up_to_root()
            self.wt = seat(self.wn, np.full(len(self.words), m.new_word()), m.d[0], stirling[0], rng)

    def up_to_root(self) -> None:
        self.wn = self._sum(self.word, self.gt, len(self.words))

    def totals(self) -> list[tuple[int, int, float, float]]:
        """(0, 0, customers and tables of the root); level -1-k holds how many
        words level k has seen once and twice."""
        out = [(0, 0, float(self.wn.sum()), float(self.wt.sum()))]
        return out + [(-1 - k, 0, float((n == 1).sum()), float((n == 2).sum())) for k, n in enumerate((self.wn, self.gn, self.n))]


def sample(state: Seating, m: Totals, seed: int, average: bool, root: np.ndarray):
    """Run one round; the averaged predictive probabilities if asked for."""
    rng, stirling = np.random.default_rng(seed), [log_stirling(d) for d in m.d]
    mean, at_root = None, root[state.word]
    for s in range(SWEEPS):
        state.sweep(m, stirling, rng, at_root)
        if average and s >= BURN_IN:
            now = state.predict(m, root, at_root)
            mean = [np.zeros(len(x)) for x in now] if mean is None else mean
            for total, x in zip(mean, now):
                total += x
    for total in mean or ():
        total /= SWEEPS - BURN_IN
    state.up_to_root()
    return mean


def lookup(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each key and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def probabilities(state: Seating, mean, m: Totals, words: np.ndarray, contexts: np.ndarray, parents: np.ndarray | None = None) -> np.ndarray:
    """Averaged predictive probability of words (unique per call or not) in
    contexts, backing off to the parents' where nothing was seen."""
    root, group, pair = mean
    if not len(state.n):
        return np.full(len(words), m.new_word() / (m.n + m.strength[0]))
    size = len(state.words)
    w, known = lookup(state.words, words)
    c, is_context = lookup(state.contexts, contexts)
    at, there = lookup(state.pairs, c * size + w)
    there &= known & is_context
    if there.all():
        return pair[at]
    u, is_parent = lookup(state.parents, np.zeros(len(words), dtype=np.int64) if parents is None else parents)
    u, is_parent = np.where(is_context, state.parent_of_context[c], u), is_context | is_parent
    p = np.where(known, root[w], m.new_word() / (m.n + m.strength[0]))
    g, in_group = lookup(state.groups, u * size + w)
    parent_n, parent_t = state._of_parents()
    fresh = (m.strength[1] + m.d[1] * parent_t) / (parent_n + m.strength[1])
    p = np.where(in_group & known & is_parent, group[g], np.where(is_parent, fresh[u], 1.0) * p)
    fresh = state._fresh(m) / (state.context_n + m.strength[2])
    return np.where(there, pair[at], np.where(is_context, fresh[c], 1.0) * p)


# --------------------------------------------------------------- documents


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Words with one end after each document, and their documents' numbers."""
    split = W.split_words(part.column("text"))
    sizes = np.diff(split.first) + 1
    words = np.empty(int(sizes.sum()), dtype=np.uint64)
    is_end = np.zeros(len(words), dtype=bool)
    is_end[np.cumsum(sizes) - 1] = True
    words[is_end], words[~is_end] = _END, split.hashes
    return words, np.repeat(np.arange(len(sizes)), sizes)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Documents (without text) and tokens in chunks of about CHUNK_TOKENS."""
    parts, held = [], 0
    for batch in batches:
        for part in W.chunks(batch, "text"):
            tokens = _tokens(part)
            parts.append((part.drop_columns(["text"]), *tokens))
            held += len(tokens[0])
            if held >= CHUNK_TOKENS:
                chunk, parts, held = _joined(parts), [], 0
                yield chunk
                del chunk  # before the next one is read
    if parts:
        yield _joined(parts)


def _joined(parts):
    table = pa.Table.from_batches([p[0] for p in parts]).combine_chunks()
    shift = np.cumsum([0, *[p[0].num_rows for p in parts[:-1]]])
    return (
        table.to_batches()[0],
        np.concatenate([p[1] for p in parts]),
        np.concatenate([p[2] + s for p, s in zip(parts, shift)]),
    )


def _triples(words: np.ndarray, doc: np.ndarray):
    """The sorted distinct words; and tokens, sorted, as places in them of the
    previous word, the one before it and the word, with their documents."""
    is_first = _is_first(doc)
    unique, w = np.unique(np.append(words, _START), return_inverse=True)
    start, w = w[-1], w[:-1]
    v, x = np.empty_like(w), np.empty_like(w)
    v[1:] = w[:-1]
    v[is_first] = start
    x[1:] = v[:-1]
    x[is_first] = start
    order = _triple_order(v, x, w, len(unique))
    return unique, v[order], x[order], w[order], doc[order]


def _bucket_cuts(words: np.ndarray, n: int) -> tuple[list[int], list[int], list[int]]:
    """Buckets, of ``n`` equal ranges, that sorted words touch, and where each
    begins and ends."""
    buckets = ((words >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
    buckets, starts = np.unique(buckets, return_index=True)
    return buckets.tolist(), starts.tolist(), [*starts[1:].tolist(), len(words)]


_STORED = "bucket long, part long, tokens long, blob binary, chunks array<long>, pieces array<binary>"


def _coded_words(docs: DataFrame, n_tokens: float) -> np.ndarray:
    """Sorted frequent words, of a bounded sample of the texts. They shorten
    blobs; no result depends on which words they are."""

    def count(batches):
        for _, words, _ in _chunks(batches):
            found, n = np.unique(words, return_counts=True)
            top = np.argsort(-n, kind="stable")[:CODED]
            yield pa.RecordBatch.from_arrays([pa.array([pack(found[top], n[top].astype("u4"))], pa.binary())], names=["blob"])

    some = docs.sample(min(1.0, CODED_FROM / max(n_tokens, 1.0)), 9).select("held_out", "text")
    parts = [unpack(r["blob"], "u8", "u4") for r in some.mapInArrow(count, "blob binary").collect()]
    words, at = np.unique(np.concatenate([np.array([_END, _START]), *[p[0] for p in parts]]), return_inverse=True)
    n = np.bincount(at, np.concatenate([np.ones(2), *[p[1] for p in parts]]))
    return np.sort(words[np.argsort(-n, kind="stable")[:CODED]])


def _stored_triples(docs: DataFrame, n_buckets: int, n_tokens: float, sent_words) -> DataFrame:
    """(bucket, part, tokens, blob, chunks, pieces): the merged triples of a
    bucket, and by chunk where its tokens stand; one row, but several of some
    chunks each where a bucket has many of the about ``n_tokens`` tokens.
    Below 0, the documents of chunks without their texts, as pieces. The
    broadcast words are named by numbers."""

    def packed(chunk: int, part: pa.RecordBatch, words: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
        header = part.append_column("n_tokens", pa.array(np.bincount(doc, minlength=part.num_rows), pa.int64()))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, header.schema) as out:
            out.write_batch(header)
        n_words, (unique, v, x, w, doc) = len(words), _triples(words, doc)
        learn = ~part.column("held_out").to_numpy(zero_copy_only=False)[doc]
        first = np.flatnonzero(_is_first(v, x, w))
        n, tokens = np.add.reduceat(learn, first, dtype=np.int64), np.diff(first, append=len(v))
        v, x, w = v[first], x[first], w[first]
        buckets, starts, ends = _bucket_cuts(unique[v], n_buckets)
        at = [*first[starts].tolist(), len(doc)]
        numbers = lookup(sent_words.value, unique)
        blobs = [pack_triples(unique, v[a:b], x[a:b], w[a:b], n[a:b], tokens[a:b], doc[c:d], coded=sent_words.value, numbers=numbers) for a, b, c, d in zip(starts, ends, at, at[1:])]
        # as many parts as the bucket needs if all chunks are like this one; a token takes about five bytes
        scale = n_tokens / max(n_words, CHUNK_TOKENS // 16) * 1.25 * 5 / GROUP_BYTES
        parts = [chunk % max(1, int(np.ceil((d - c) * scale))) for c, d in zip(at, at[1:])]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*buckets, -1 - chunk % 4096], pa.int64()),
                pa.array([*parts, 0], pa.int64()),
                pa.array([chunk] * (len(blobs) + 1), pa.int64()),
                pa.array([*np.diff(at).tolist(), 0], pa.int64()),
                pa.array([*blobs, sink.getvalue().to_pybytes()], pa.binary()),
            ],
            names=["bucket", "part", "chunk", "tokens", "blob"],
        )

    def work(batches):
        seq, task = 0, TaskContext.get().partitionId()
        for tokens in _chunks(batches):
            yield packed(task * 1_000_003 + seq, *tokens)
            del tokens
            seq += 1
        W.release_memory()

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        blob, pieces = b"", list(pdf["blob"])
        if pdf["bucket"].iloc[0] >= 0:
            parts = [unpack_tokens(b, sent_words.value) for b in pieces]
            merged, places = merge_triples(parts)
            blob = pack_triples(*merged, coded=sent_words.value)
            pieces = [pack(np.diff(at, prepend=0).astype("u4"), p[5], p[6]) for at, p in zip(places, parts)]
            del parts, merged, places
        W.release_memory()
        one = {"bucket": [pdf["bucket"].iloc[0]], "part": [pdf["part"].iloc[0]], "tokens": [int(pdf["tokens"].sum())]}
        return pd.DataFrame(one | {"blob": [blob], "chunks": [pdf["chunk"].tolist()], "pieces": [pieces]})

    sent = docs.mapInArrow(work, "bucket long, part long, chunk long, tokens long, blob binary")
    return bucketed_table(sent.groupBy("bucket", "part").applyInPandas(merge, _STORED), "hpy_triples", "bucket", _slots(n_buckets))


def _whole(parts: DataFrame, sent_words) -> DataFrame:
    """The counts of buckets that are stored in parts."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        blob = pack_triples(*merge_counts(list(pdf.sort_values("part")["blob"]), sent_words.value), coded=sent_words.value)
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "tokens": [int(pdf["tokens"].sum())], "blob": [blob]})

    return cut_lineage(parts.groupBy("bucket").applyInPandas(work, "bucket long, tokens long, blob binary"), "hpy-whole")


def _slots(n_buckets: int) -> int:
    """Tasks that read the stored buckets, each with its own."""
    return min(-(-n_buckets // TASK_BUCKETS), 1 << 16)


def _with_root(counts: DataFrame, downs: DataFrame, n_buckets: int) -> DataFrame:
    """Counts with what the root sent to the bucket, in the order of words.
    Stored counts stay where they are, the root's are dealt to them."""
    sent = downs.repartition(_slots(n_buckets), "bucket").groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("part", "blob"))).alias("down"))
    return counts.join(sent, "bucket").select(*counts.columns, F.col("down.blob").alias("down"))


def _root_of(state: Seating, down: list[bytes], m: Totals) -> tuple[np.ndarray, np.ndarray]:
    """Root probabilities and training tokens of the words of a state."""
    targets = np.unique(state.word)
    n, t, raw = (np.concatenate(c) for c in zip(*[unpack(b, "u8", "u8", "u8") for b in down]))
    root, tokens = np.zeros(len(state.words)), np.zeros(len(state.words))
    root[targets], tokens[targets] = m.root(n.astype(float), t.astype(float)), raw
    return root, tokens


def _buffers(batch: pa.RecordBatch, column: str, row: int) -> list[pa.Buffer]:
    """The blobs of a list, where they lie in the batch."""
    return [b.as_buffer() for b in batch.column(column)[row].values]


_UP = "bucket long, part long, blob binary, one1 double, two1 double, one2 double, two2 double"
_DOWN = "bucket long, part long, blob binary, n double, t double, one0 double, two0 double, vocabulary double, tokens double"


def _upward(known: DataFrame, n_buckets: int, m: Totals | None, seed: int, sent_words) -> DataFrame:
    """A round of each bucket (without ``m`` the first seating): the customers
    and training tokens of each word for the root, a row per range of words."""

    def round_of(bucket: int, blob: bytes, down: list | None) -> pa.RecordBatch:
        state = Seating.of(*merge_counts([blob], sent_words.value))
        if m is not None:
            sample(state, m, hash((seed, bucket)) & 0xFFFFFFFF, False, _root_of(state, down, m)[0])
        targets = np.unique(state.word)
        words, n, raw = state.words[targets], state.wn[targets], state.raw[targets]
        parts, starts, ends = _bucket_cuts(words, -(-n_buckets // ROOT_BUCKETS))
        blobs = [pack(words[a:b], n[a:b].astype("u8"), raw[a:b].astype("u8")) for a, b in zip(starts, ends)]
        sizes = [float(x) for row in state.totals()[2:] for x in row[2:]]
        rest = [[x] + [0.0] * (len(parts) - 1) for x in sizes]
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket] * len(parts), pa.int64()), pa.array(parts, pa.int64()), pa.array(blobs, pa.binary()), *[pa.array(r, pa.float64()) for r in rest]],
            names=["bucket", "part", "blob", "one1", "two1", "one2", "two2"],
        )

    def work(batches):
        for batch in batches:
            for row in range(batch.num_rows):  # a bucket's arrays go before the next one's come
                down = _buffers(batch, "down", row) if m is not None else None
                yield round_of(batch.column("bucket")[row].as_py(), batch.column("blob")[row].as_buffer(), down)
        W.release_memory()

    return cut_lineage(known.mapInArrow(work, _UP), "hpy-up")


def _at_root(ups: DataFrame, m: Totals | None, seed: int) -> DataFrame:
    """Customers, tables and training tokens of words, for each bucket."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bucket")
        part = int(pdf["part"].iloc[0])
        got = [unpack(b, "u8", "u8", "u8") for b in pdf["blob"]]
        words, at = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        n, raw = (Seating._sum(at, np.concatenate([g[k] for g in got]), len(words)) for k in (1, 2))
        t = np.minimum(n, 1)
        if m is not None:
            t = seat(n, np.full(len(n), m.new_word()), m.d[0], log_stirling(m.d[0]), np.random.default_rng(hash((seed, part, -1)) & 0xFFFFFFFF))
        ends = np.cumsum([0, *[len(g[0]) for g in got]]).tolist()
        out = pd.DataFrame({"bucket": pdf["bucket"].to_numpy(), "part": part})
        out["blob"] = [pack(*[c[at[a:b]].astype("u8") for c in (n, t, raw)]) for a, b in zip(ends, ends[1:])]
        sums = {"n": n.sum(), "t": t.sum(), "one0": (n == 1).sum(), "two0": (n == 2).sum(), "vocabulary": (raw > 0).sum(), "tokens": raw.sum()}
        return out.assign(**{k: [float(x)] + [0.0] * (len(out) - 1) for k, x in sums.items()})

    return cut_lineage(ups.groupBy("part").applyInPandas(work, _DOWN), "hpy-down")


def _free(df: DataFrame) -> None:
    """Let Spark delete the shuffle files of tables that are written."""
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def _round(known: DataFrame, n_buckets: int, m: Totals | None, seed: int, sent_words) -> tuple[DataFrame, Totals, int]:
    """What the root sends after a round over all buckets, the totals (sums of
    ten numbers) and the number of training tokens."""

    def sums(df: DataFrame, *names: str) -> list[float]:
        return [x or 0.0 for x in df.agg(*[F.sum(c) for c in names]).first()]

    ups = _upward(known, n_buckets, m, seed, sent_words)
    one1, two1, one2, two2 = sums(ups, "one1", "two1", "one2", "two2")
    _free(ups)
    downs = _at_root(ups, m, seed)
    drop_table(ups)
    n, t, one0, two0, vocabulary, tokens = sums(downs, "n", "t", "one0", "two0", "vocabulary", "tokens")
    return downs, Totals({(0, 0): (n, t)}, {0: (one0, two0), 1: (one1, two1), 2: (one2, two2)}, int(vocabulary)), int(tokens)


def score_texts(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", seed: int = 9) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, held_out, n_tokens, n_known,
    train_tokens (long), base_score and score (double, log10), perplexity.

    Learns from the rows where ``held_out`` (a Column) is not true. A text's
    tokens are its words, A-Z lower-cased, and one end; a null text has only
    the end. base_score adds log10((c + 0.5) / (N + 0.5 (V + 1))) over the
    tokens; score is the model's. Ids may be null or repeat, other columns are
    not read; an empty table gives an empty result, and without any training
    row every token is unknown.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, int(np.ceil(volume / 6 / BUCKET_TOKENS)))  # about six bytes a token
    sent_words = docs.sparkSession.sparkContext.broadcast(_coded_words(rows, volume / 6))
    stored = _stored_triples(rows, n_buckets, volume / 6, sent_words)
    _free(stored)
    found = stored.where("bucket >= 0")
    # buckets in parts, few; the others are read where they lie in each round
    split = [r["bucket"] for r in found.groupBy("bucket").count().where("count > 1").collect()]
    _free(stored)  # once more, now that the listeners have let go of the plan
    in_parts = F.col("bucket").isin(split)
    counts = [found.where(~in_parts).select("bucket", "tokens", "blob")]
    if split:
        whole = _whole(found.where(in_parts), sent_words)
        counts.append(whole)
    downs, m, n_train = _round(reduce(DataFrame.unionByName, counts), n_buckets, None, seed, sent_words)
    for r in range(ROUNDS - 1):
        last = downs
        downs, m, _ = _round(reduce(DataFrame.unionByName, [_with_root(c, last, n_buckets) for c in counts]), n_buckets, m, seed + r, sent_words)
        drop_table(last)
    _free(stored)

    def score_row(bucket: int, blob: bytes, own: bytes | None, down: list, chunks: list, pieces: list) -> pa.RecordBatch:
        words, v, x, w, n = merge_counts([blob], sent_words.value)
        state = Seating.of(words, v, x, w, n)
        root, raw = _root_of(state, down, m)
        mean = sample(state, m, hash((seed + ROUNDS, bucket)) & 0xFFFFFFFF, True, root)
        if own is not None:  # a part of the bucket's triples
            words, *places, _ = merge_counts([own], sent_words.value)
            v, x, w = (np.searchsorted(state.words, words)[c] for c in places)
        there, base = (raw > 0)[w], np.log10((raw + 0.5) / (n_train + 0.5 * (m.vocabulary + 1)))[w]
        p = np.log10(probabilities(state, mean, m, state.words[w], v * len(state.words) + x, v) if own is not None else mean[2])
        out = []
        for piece in pieces:
            steps, runs, doc = unpack(piece, *PIECE)
            at = np.repeat(np.cumsum(steps), runs)
            docs_here = np.flatnonzero(np.bincount(doc))
            known, *sums = (np.bincount(doc, weights=c[at])[docs_here] for c in (there, base, p))
            sums = (np.rint(np.ldexp(-c, SCORE_BITS)).astype("u8") for c in sums)
            out.append(pack(np.diff(docs_here, prepend=0).astype("u4"), known.astype("u4"), *sums))
        return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array([False] * len(out)), pa.array(out, pa.binary())], names=["chunk", "is_header", "blob"])

    def score(batches):
        for batch in batches:
            for row in range(batch.num_rows):  # a bucket's arrays go before the next one's come
                bucket, chunks = (batch.column(c)[row].as_py() for c in ("bucket", "chunks"))
                yield score_row(bucket, *(batch.column(c)[row].as_buffer() for c in ("blob", "own")), _buffers(batch, "down", row), chunks, _buffers(batch, "pieces", row))
        W.release_memory()

    def scores_of(pieces: DataFrame) -> DataFrame:
        return pieces.select("bucket", "blob", "own", "down", "chunks", "pieces").mapInArrow(score, "chunk long, is_header boolean, blob binary")

    headers = stored.where("bucket < 0").select(F.inline(F.arrays_zip("chunks", "pieces"))).select(F.col("chunks").alias("chunk"), F.lit(True).alias("is_header"), F.col("pieces").alias("blob"))
    no_own = F.lit(None).cast("binary").alias("own")
    scored = headers.unionByName(scores_of(_with_root(found.where(~in_parts).withColumn("own", no_own), downs, n_buckets)))
    if split:
        parts = found.where(in_parts).select("bucket", "part", F.col("blob").alias("own"), "chunks", "pieces").join(_with_root(whole, downs, n_buckets), "bucket")
        scored = scored.unionByName(scores_of(parts.repartition(min(n_buckets, 1 << 16), "bucket", "part")))

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        header = pa.ipc.open_stream(pdf.loc[pdf["is_header"], "blob"].iloc[0]).read_all()
        known, base, own = (np.zeros(header.num_rows, np.int64) for _ in range(3))
        for blob in pdf.loc[~pdf["is_header"], "blob"]:  # in any order, the numbers are whole
            steps, *sums = unpack(blob, "u4", "u4", "u8", "u8")
            at = np.cumsum(steps)
            for total, c in zip((known, base, own), sums):
                total[at] += c.astype(np.int64)
        base, own = (np.ldexp((-c).astype(float), -SCORE_BITS) for c in (base, own))
        out = header.to_pandas(integer_object_nulls=True)
        n = out["n_tokens"].to_numpy()
        return out.assign(n_known=known, train_tokens=n_train, base_score=base, score=own, perplexity=10.0 ** (-own / n))

    schema = f"id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return scored.groupBy("chunk").applyInPandas(gather, schema).withColumnRenamed("id", id_col)

