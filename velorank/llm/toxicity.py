"""Toxicity scores by the nearest labelled examples under exact TF-IDF cosine.

Examples sit in an inverted index whose posting lists are cut into blocks of
examples, each with its largest weight.  The sum of those bounds says how similar
an example of a block can be at most, so blocks that can't reach the nearest ones
found so far are skipped and the result is that of comparing all.

All words of all examples count.  The weight of a word is its TF-IDF, multiplied by
how strongly it goes with the label where it clearly does.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velorank.llm.common import small_batches, stored, whole_text

_WORD = re.compile(r"[^\W\d_]+")
# ASCII letters in lower case, other ASCII as blanks; bytes of other characters stay.
_LETTERS = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(256))
_BLOCK = 256
# Blocks looked at first, best bound first, to know what the others must reach.
_FIRST = 3
# Terms in more than this share of examples are multiplied out for many texts at once; their lists would be nearly full.
_COMMON = 1 / 16
# Where the median bound is this share of the third, few blocks can be left out: all are scored at once.
_LEVEL = 0.4
# Texts compared at once.
_TEXTS = 256
# More than what sums of single precision are off by; whatever is this near is compared in full.
_ROUNDING = 1e-5
# A posting: where the example stands and its weight for the term.
_POST = np.dtype([("place", np.int32), ("weight", np.float32)])
# Added to the nearest examples' votes with the label share of all, so few weak neighbours don't decide.
_PRIOR = 0.05
_BINS = 20

# Term numbers, ascending, and a number (count or weight) for each.
Sparse = tuple[np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Settings:
    """``examples``: labelled rows used at most (the ones of smallest id hash, whatever
    the input's size).  ``association``: least chi-squared value between a term and the
    label from which the term's weight is multiplied by the root of that value, if above 1.
    ``neighbours``: nearest examples that vote.
    """

    examples: int = 8192
    association: float = 9.0
    neighbours: int = 15
    threshold: float = 0.7


def words(text: str) -> list[str]:
    """The text's runs of letters, in lower case."""
    if text.isascii():  # the same, several times faster
        return text.encode().translate(_LETTERS).decode("ascii").split()
    parts = text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).decode("utf-8", "surrogatepass").split()
    if "".join(parts).isalpha():
        return parts
    return [w for part in parts for w in ((part,) if part.isalpha() else _WORD.findall(part))]


def terms(text: str) -> Counter[str]:
    """Terms of a text: its words and how often it has them."""
    return Counter(words(text))


def association(found: np.ndarray, positive: np.ndarray, examples: int, positives: int) -> np.ndarray:
    """Chi-squared of each term with the label, from the examples and positive examples that hold it."""
    a, b = positive.astype(float), (found - positive).astype(float)
    c, d = positives - a, (examples - positives) - b
    spread = (a + b) * (c + d) * (a + c) * (b + d)
    return np.where(spread > 0, examples * (a * d - b * c) ** 2 / np.where(spread > 0, spread, 1), 0.0)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class BlockMaxIndex:
    """Unit vectors of examples by term, in blocks; ``nearest`` is exact.

    Blocks hold examples of the same heaviest term, so that few of them matter to a query.
    """

    def __init__(self, vectors: list[Sparse], size: int, block: int = _BLOCK) -> None:
        """``size``: the number of terms."""
        self._block, self._blocks, self._size = block, -(-len(vectors) // block), size
        lengths = np.array([len(t) for t, _ in vectors], np.int64)
        heaviest = [int(t[np.argmax(w)]) if len(t) else -1 for t, w in vectors]
        self._order = np.array(sorted(range(len(vectors)), key=lambda i: (heaviest[i], i)), np.int64)
        self._place = np.empty(len(vectors), np.int32)
        self._place[self._order] = np.arange(len(vectors))
        # Examples one after the other, to compare the few that are left in full.
        self._terms = np.concatenate([t for t, _ in vectors] + [np.zeros(0, np.int32)], dtype=np.int32)
        self._weights = np.concatenate([w for _, w in vectors] + [np.zeros(0)])
        self._starts = np.concatenate([[0], np.cumsum(lengths)])
        seen: dict[tuple[bytes, bytes], int] = {}
        self._like = np.array([seen.setdefault((t.tobytes(), w.tobytes()), i) for i, (t, w) in enumerate(vectors)], np.int64)
        del seen
        # Posting lists by term and place, a place and its weight side by side.
        places = np.repeat(self._place, lengths)
        by_term = np.lexsort((places, self._terms))
        self._posts = np.empty(len(by_term), _POST)
        self._posts["place"] = places[by_term]
        del places
        self._posts["weight"] = self._weights.astype(np.float32)[by_term]
        self._whole = self._posts.view(np.int64)  # copied faster than by field
        listed = self._terms[by_term]
        del by_term
        held = np.bincount(listed, minlength=size)
        common = np.flatnonzero(held > max(_COMMON * len(vectors), 1))
        self._row = np.full(size, -1, np.int32)
        self._row[common] = np.arange(len(common))
        self._dense = np.zeros((len(common), self._blocks * block), np.float32)
        dense = np.flatnonzero(self._row[listed] >= 0)
        self._dense[self._row[listed[dense]], self._posts["place"][dense]] = self._posts["weight"][dense]
        del dense
        # The part of a list in one block: its block, its first posting and its largest weight.
        blocks = self._posts["place"] // block
        fresh = np.ones(len(listed), bool)
        fresh[1:] = (listed[1:] != listed[:-1]) | (blocks[1:] != blocks[:-1])
        first = np.flatnonzero(fresh)
        self._part_block = blocks[first]
        del blocks
        self._part_start = np.append(first, len(listed)).astype(np.int32)
        self._part_most = np.maximum.reduceat(self._posts["weight"], first) if len(first) else np.zeros(0)
        self._term_start = np.searchsorted(listed[first], np.arange(size + 1, dtype=np.int32)).astype(np.int32)
        self._post_start = np.append(0, np.cumsum(held)).astype(np.int32)

    def vectors(self) -> list[Sparse]:
        """The examples it was made of."""
        return [(self._terms[a:b], self._weights[a:b]) for a, b in zip(self._starts[:-1], self._starts[1:])]

    def nearest(self, queries: list[Sparse], k: int, without: list[list[int]] | None = None) -> list[list[tuple[int, float]]]:
        """For each query the ``k`` most similar examples that share a term, ties to the first ones.

        Examples ``without`` lists for a query are left out of its result.
        """
        out: list[list[tuple[int, float]]] = []
        weight = np.zeros(self._size)
        for at in range(0, len(queries), _TEXTS):
            some = queries[at : at + _TEXTS]
            shared = np.zeros((len(some), len(self._dense)), np.float32)
            for n, (mine, weights) in enumerate(some):
                rows = self._row[mine]
                shared[n, rows[rows >= 0]] = weights[rows >= 0]
            known = shared @ self._dense
            for n, query in enumerate(some):
                out.append(self._nearest(query, known[n].reshape(self._blocks, self._block), k, without[at + n] if without else [], weight))
        return out

    def _nearest(
        self, query: Sparse, known: np.ndarray, k: int, without: list[int], weight: np.ndarray
    ) -> list[tuple[int, float]]:
        """``known``: what common terms give to the similarity of each place, by block.  ``weight``: zeros, a place per term."""
        if not self._blocks:
            return []
        rare = self._row[query[0]] < 0
        mine, weights = query[0][rare], query[1][rare]
        starts = self._term_start[mine]
        lengths = self._term_start[mine + 1] - starts
        parts, by_part = _ranges(starts, lengths), np.repeat(weights, lengths)
        blocks = self._part_block.take(parts)
        bounds = known.max(axis=1) + np.bincount(blocks, by_part * self._part_most.take(parts), self._blocks)
        left_out = self._place[without]

        def scores(able: np.ndarray) -> np.ndarray:
            """Similarity of the places in these blocks, by block; 0 elsewhere."""
            whole = bool(able.all())
            if whole:  # whole lists
                at, ends = self._post_start[mine], self._post_start[mine + 1]
                many, each = ends - at, weights
                posts = np.concatenate([self._whole[:0], *[self._whole[a:b] for a, b in zip(at.tolist(), ends.tolist())]])
            else:
                use = np.flatnonzero(able.take(blocks))
                some = parts.take(use)
                at, each = self._part_start.take(some), by_part.take(use)
                many = self._part_start.take(some + 1) - at
                posts = self._whole.take(_ranges(at, many))
            posts = posts.view(_POST)
            found = np.bincount(posts["place"], np.repeat(each, many) * posts["weight"], known.size).reshape(known.shape)
            found = found + (known if whole else known * able[:, None])
            found.reshape(-1)[left_out] = 0.0
            return found

        def last(found: np.ndarray) -> float:
            return float(np.partition(found, -k)[-k]) if len(found) >= k else 0.0

        order = np.argsort(-bounds, kind="stable")
        level = bounds[order[self._blocks // 2]] >= _LEVEL * bounds[order[min(_FIRST, self._blocks) - 1]]
        first = order if level else order[:_FIRST]
        done = np.zeros(self._blocks, bool)
        done[first] = True
        found = scores(done)
        least = last(found[first].reshape(-1))
        # A bound equal to the last one found, give or take rounding, could still tie.
        able = (bounds > 0) & (bounds >= least - _ROUNDING) & ~done
        flat = (found + scores(able) if able.any() else found).reshape(-1)
        near = np.flatnonzero((flat > 0) & (flat >= least - _ROUNDING))
        if len(near) > k:
            near = near[flat[near] >= last(flat[near]) - _ROUNDING]
        who = np.sort(self._order[near])
        if not len(who):
            return []
        # Those left are compared in full, copies once, in one order of adding, so that a text always finds the same.
        weight[query[0]] = query[1]
        distinct, which = np.unique(self._like[who], return_inverse=True)
        many = self._starts[distinct + 1] - self._starts[distinct]
        at = _ranges(self._starts[distinct], many)
        exact = np.add.reduceat(weight.take(self._terms.take(at)) * self._weights.take(at), np.cumsum(many) - many)[which]
        weight[query[0]] = 0.0
        top = np.lexsort((who, -exact))[:k]
        return list(zip(who[top].tolist(), exact[top].tolist()))


def _monotone(counts: np.ndarray, ones: np.ndarray, share: float) -> np.ndarray:
    """Non-decreasing rates nearest to those of the bins (pool adjacent violators)."""
    pools: list[list[float]] = []
    for n, y in zip(counts, ones):
        pools.append([y + share * 0.5, n + 0.5, 1])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            y1, n1, w1 = pools.pop()
            pools[-1] = [pools[-1][0] + y1, pools[-1][1] + n1, pools[-1][2] + w1]
    return np.concatenate([np.full(int(w), y / n) for y, n, w in pools])


class NeighbourModel:
    """Scores term counts; small enough, by :class:`Settings`, to be sent to every task."""

    def __init__(
        self, ids: list, labels: list[int], counts: list[Sparse], contents: list[int], weights: np.ndarray, settings: Settings
    ) -> None:
        """``weights`` has a factor per term."""
        self.ids, self.labels, self.weights, self.settings = ids, np.array(labels, float), weights, settings
        vectors = [self._vector(c) for c in counts]
        self._vectors: list[Sparse] | None = None  # set only on the way to a task
        self._index: BlockMaxIndex | None = BlockMaxIndex(vectors, len(weights))
        self.share = float(self.labels.mean()) if len(labels) else 0.0
        bare = np.array([not len(t) for t, _ in counts], bool)
        # What an example without any word is likely to be labelled.
        self.plain = float((self.labels[bare].sum() + self.share) / (bare.sum() + 1)) if len(labels) else 0.0
        # Calibration leaves out an example and its copies; a score leaves out nothing, so equal texts score alike.
        alike: dict[int, list[int]] = {}
        for i, content in enumerate(contents):
            alike.setdefault(content, []).append(i)
        worded = np.flatnonzero(~bare).tolist()
        near = self.index.nearest([vectors[i] for i in worded], settings.neighbours, [alike[contents[i]] for i in worded])
        at = np.array([min(int(self._vote(n) * _BINS), _BINS - 1) for n in near], int)
        marks = self.labels[worded]
        self.rates = _monotone(np.bincount(at, minlength=_BINS), np.bincount(at, weights=marks, minlength=_BINS), self.share)

    @property
    def index(self) -> BlockMaxIndex:
        """Built where it is used; only the examples' vectors are sent."""
        if self._index is None:
            self._index = BlockMaxIndex(self._vectors, len(self.weights))
            self._vectors = None  # the index has them
        return self._index

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_vectors": self._vectors or self.index.vectors(), "_index": None}

    def _vector(self, counts: Sparse) -> Sparse:
        raw = (1 + np.log(counts[1])) * self.weights[counts[0]]
        norm = np.sqrt((raw * raw).sum())
        return counts[0], raw / norm if norm else raw

    def _vote(self, near: list[tuple[int, float]]) -> float:
        weight = sum(s for _, s in near)
        return (sum(s * self.labels[i] for i, s in near) + _PRIOR * self.share) / (weight + _PRIOR)

    def scores(self, counts: list[Sparse]) -> list[tuple[float, list[tuple[object, float, int]]]]:
        """Calibrated score and the nearest examples of each text; they depend on the text alone."""
        middle = (np.arange(_BINS) + 0.5) / _BINS
        out = []
        for near in self.index.nearest([self._vector(c) for c in counts], self.settings.neighbours):
            score = float(np.interp(self._vote(near), middle, self.rates)) if near else self.plain
            out.append((score, [(self.ids[i], s, int(self.labels[i])) for i, s in near]))
        return out


def _learnt(
    docs: DataFrame, labels: DataFrame, settings: Settings, id_column: str, text: str, label: str
) -> tuple[Broadcast, Callable[[str], Sparse]]:
    """The model for every task, and what numbers and counts a text's terms."""
    spark = docs.sparkSession
    known = labels.where(F.col(id_column).isNotNull() & F.col(label).isin(0, 1))
    chosen = (
        known.groupBy(id_column).agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64(F.col(id_column)), id_column).limit(settings.examples)
    )
    texts = docs.select(F.col(id_column).alias("id"), whole_text(text).alias("text"))
    chosen = F.broadcast(stored(chosen).select(F.col(id_column).alias("id"), "label"))  # at most settings.examples rows
    sample = stored(
        texts.join(chosen, "id").groupBy("id").agg(F.first("label").alias("label"), F.min("text").alias("text"))
        .withColumn("content", F.xxhash64("text"))
    )

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            yield pa.RecordBatch.from_arrays([pa.array([t for x in batch.column(0).to_pylist() for t in terms(x)], pa.string())], ["term"])

    # The terms of the examples, numbered in their order; the frequent ones stand together in memory, so that lookups are fast.
    found = sample.select("text").mapInArrow(listed, "term string").groupBy("term").count().toArrow()
    numbers = {t: n for n, t in enumerate(sorted(found.column(0).to_pylist()))}
    frequent = found.sort_by([("count", "descending"), ("term", "ascending")]).column(0).to_pylist()
    vocabulary = spark.sparkContext.broadcast({t: numbers[t] for t in frequent})
    size = len(vocabulary.value)

    def numbered(content: str) -> Sparse:
        mine, number = terms(content), vocabulary.value
        at = np.fromiter(map(number.get, mine, repeat(-1)), np.int32, len(mine))
        order = np.argsort(at)
        order = order[at[order] >= 0]
        return at[order], np.fromiter(mine.values(), np.int32, len(mine))[order]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            mine = [numbered(x) for x in batch.column(3).to_pylist()]
            lists = [pa.array([x[k] for x in mine], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], ["id", "label", "content", "terms", "counts"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """In how many of a task's texts each term is; as term -1 how many texts there are."""
        seen, total, number = np.zeros(size + 1, np.int64), 0, vocabulary.value
        for batch in small_batches(batches):
            total += batch.num_rows
            for x in batch.column(0).to_pylist():
                mine = set(words(x))
                seen[np.fromiter(map(number.get, mine, repeat(size)), np.int64, len(mine))] += 1
        held = np.flatnonzero(seen[:size])
        for at in range(0, len(held) + 1, 1 << 16):
            some = held[at : at + (1 << 16)]
            rows = [np.append(some, -1), np.append(seen[some], 0 if at else total)]
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64())], ["term", "n"])

    kind = docs.schema[id_column].dataType.simpleString()
    examples = (
        sample.select("id", "label", "content", "text")
        .mapInArrow(counted, f"id {kind}, label int, content bigint, terms array<int>, counts array<int>")
        .orderBy("id").toArrow().combine_chunks()
    )
    counts = [
        (t.values.to_numpy(), n.values.to_numpy()) for t, n in zip(examples.column("terms"), examples.column("counts"))
    ]
    marks = np.array(examples.column("label").to_pylist(), np.int64)
    spreads = texts.select("text").mapInArrow(spread, "term int, n bigint")
    everywhere = spreads.groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # a row per term of the examples
    seen = np.zeros(size + 1)  # the last place is that of term -1
    seen[everywhere.column("term").to_numpy()] = everywhere.column("n").to_numpy()
    none = np.zeros(0, np.int32)
    held = np.bincount(np.concatenate([none, *[t for t, _ in counts]]), minlength=size)
    positive = np.bincount(np.concatenate([none, *[t for (t, _), y in zip(counts, marks) if y]]), minlength=size)
    chi = association(held, positive, len(counts), int(marks.sum()))
    factor = np.where(chi >= settings.association, np.maximum(np.sqrt(chi), 1.0), 1.0)
    weights = (np.log((1 + seen[-1]) / (1 + seen[:-1])) + 1) * factor
    model = NeighbourModel(
        examples.column("id").to_pylist(), marks.tolist(), counts, examples.column("content").to_pylist(), weights, settings
    )
    return spark.sparkContext.broadcast(model), numbered


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text: str = "text",
    label: str = "toxic",
) -> DataFrame:
    """One row per row of ``docs``: its id, ``score``, ``predicted``, ``evidence``.

    ``labels`` has ids and labels 0 or 1 to learn from; null ids and labels are left
    out, and of differing labels of an id the larger holds.  ``evidence`` lists the
    nearest examples (``id``, ``similarity``, ``label``).  Every text that shares a word
    with an example is searched; others, null and empty ones included, get the share of
    label 1 among examples without words; without examples every score is 0.  Repeated
    rows get equal scores, of texts of one id the smallest is learnt from; an empty table
    gives an empty one; other columns are ignored.

    Term weights count over all documents.  The texts are read three times: for the
    examples, for the weights and to be scored; none but the examples are kept.
    """
    shared, numbered = _learnt(docs, labels, settings, id_column, text, label)
    kind = docs.schema[id_column].dataType.simpleString()
    id_kind = pa.from_numpy_dtype("int64") if kind in ("bigint", "int", "smallint") else pa.string()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in small_batches(batches):
            out = model.scores([numbered(x) for x in batch.column(1).to_pylist()])
            score = np.array([s for s, _ in out], float)
            near = [n for _, e in out for n in e]
            ids = pa.array([i if id_kind == pa.int64() else str(i) for i, _, _ in near], id_kind)
            parts = [ids, pa.array([s for _, s, _ in near], pa.float64()), pa.array([y for _, _, y in near], pa.int32())]
            evidence = pa.ListArray.from_arrays(
                np.cumsum([0, *[len(e) for _, e in out]], dtype=np.int32), pa.StructArray.from_arrays(parts, ["id", "similarity", "label"])
            )
            columns = [batch.column(0), pa.array(score), pa.array((score >= settings.threshold).astype(np.int32)), evidence]
            yield pa.RecordBatch.from_arrays(columns, [id_column, "score", "predicted", "evidence"])

    id_name = "bigint" if id_kind == pa.int64() else "string"
    return docs.select(F.col(id_column), whole_text(text).alias("_text")).mapInArrow(
        scored,
        f"`{id_column}` {kind}, score double, predicted int, evidence array<struct<id:{id_name},similarity:double,label:int>>",
    )


def drop_toxic(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text: str = "text",
    label: str = "toxic",
) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with all their columns.

    Each row is scored by its own text, whether or not its id is null or repeats.
    """
    shared, numbered = _learnt(docs, labels, settings, id_column, text, label)
    texts = docs.columns.index(text)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in small_batches(batches):
            scores = model.scores([numbered(content or "") for content in batch.column(texts).to_pylist()])
            yield batch.filter(pa.array([s < settings.threshold for s, _ in scores], pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
