"""Hashed maximum-entropy language model, trained and scored in numpy batches.

The most frequent ``classes * members`` words are dealt into classes by frequency; one
more class, the tail, has all other words. A word's probability is that of its class
times its own within it, both softmax over rows of weights that hashed features
select: the word before, the one before that (a skip), the pair of both, and a
constant. Within the tail a word has its smoothed share of the tail's tokens, which
the exact counts of all training text give.

**Training.** Every task takes gradient steps over its own documents from the same
weights and sends, for each row of weights it touched, how far it moved and how often.
Moves are averaged by how often, summed while they stream, and the next round starts
from there. Every training document is used in exactly one round. What a task sends is
as large as the weights, so a round has no more tasks than its texts are larger than
the weights (but for ``LEAST_TASKS``): moves take no more disk than texts do.

**Counts.** Tasks know the ``known`` most frequent words, a bounded table. Other words
are joined to their counts by a shuffle: they are rare, so no key is hot.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import removed, written
from quotelake.llm.tokens import in_pieces

#: The end of a text; no word is empty.
END = b""

#: Above all ids of known words.
UNKNOWN = 1 << 32

#: Words a task counts before it passes them on.
COUNTED = 400_000

#: Bytes of a piece of a batch whose words are told apart at once.
PIECE = 8_000_000

#: Training tasks of a round, if there are as many partitions, however small the texts.
LEAST_TASKS = 8

#: Rows of weights that a task sends together, and of a softmax that stay in the cache.
SENT, CACHED = 64, 1024

#: Rows that occur more often in a batch are summed one by one.
FREQUENT = 16


@dataclass(frozen=True)
class ModelConfig:
    """``classes``, ``members`` and the hashed rows are those of a small corpus; ``sized``
    lets them grow with its words. ``weight_bytes`` bounds the weights, which every
    task holds."""

    classes: int = 64
    members: int = 64
    known: int = 262_144
    class_rows: int = 1 << 14
    member_rows: int = 1 << 13
    rounds: int = 2
    batch: int = 8192
    rate: float = 0.3
    folds: int = 5
    held_out: int = 1
    weight_bytes: int = 128 << 20

    def sized(self, types: int) -> ModelConfig:
        """Hashed rows double with the training types, classes and members with their
        fourth root, as far as the weights keep to their bound."""
        found, least = self, 1 << 20
        while types > least:
            least *= 2
            wider = 2 if (least.bit_length() - 21) % 4 == 0 else 1
            larger = replace(
                found,
                classes=wider * found.classes,
                members=wider * found.members,
                class_rows=2 * found.class_rows,
                member_rows=2 * found.member_rows,
            )
            if larger.model_bytes > self.weight_bytes:
                break
            found = larger
        return found

    @property
    def model_bytes(self) -> int:
        return 4 * (self.class_rows * (self.classes + 1) + self.member_rows * self.members)

    @property
    def head(self) -> int:
        return self.classes * self.members


def tokens_of(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


@dataclass(frozen=True)
class Tokens:
    """Tokens of some texts: the distinct ones, the place of each token among them, and
    the number of tokens of each text."""

    words: list[bytes]
    codes: np.ndarray
    sizes: np.ndarray


def tokens_in(batch: pa.RecordBatch) -> Tokens:
    """What ``tokens_of`` finds in each text of a batch."""
    none, gap = (pa.scalar(x, pa.large_string()) for x in ("", " "))
    # A copy: Arrow reads slices that were cast to large strings from a wrong place.
    texts = pa.concat_arrays([batch.column("text")]).cast(pa.large_string()).fill_null(none)
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    # Behind a last space stands an empty word, the end; an empty text is that alone.
    texts = pc.binary_join_element_wise(texts, pc.if_else(pc.equal(texts, none), none, gap), none)
    split = pc.ascii_split_whitespace(texts)
    found = split.flatten().dictionary_encode()
    return Tokens(
        found.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist(),
        found.indices.to_numpy(),
        split.value_lengths().to_numpy().astype(np.int64),
    )


def with_fold(docs: DataFrame, cfg: ModelConfig) -> DataFrame:
    """doc_id, text and held_out; a row without doc_id is for training."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % cfg.folds
    return docs.select("doc_id", "text", F.coalesce(fold == cfg.held_out, F.lit(False)).alias("held_out"))


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def passed_on() -> pa.RecordBatch:
        columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["token", "n"])

    for batch in in_pieces(batches, size=PIECE):
        tokens = tokens_in(batch)
        times = np.bincount(tokens.codes, minlength=len(tokens.words))
        for word, n in zip(tokens.words, times.tolist()):
            counts[word] += n
        if len(counts) >= COUNTED:
            yield passed_on()
            counts.clear()
    yield passed_on()


def token_counts(docs: DataFrame) -> DataFrame:
    """(token, n) over all of ``docs``, the end of a text included."""
    partial = docs.select("text").mapInArrow(_counting, "token binary, n bigint")
    return partial.groupBy("token").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """At most ``most`` words, most frequent first: all from some frequency on.

    The frequency comes from a histogram in steps of a sixteenth of a power of two,
    so only words that are taken leave their tasks.
    """
    step = F.floor(F.log2("n") * 16).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()
    least, taken = None, 0
    for row in sorted(sizes, key=lambda r: -r["step"]):
        taken += row["words"]
        if taken > most:
            break
        least = row["step"]
    if least is None:
        return []
    top = counts.filter(step >= least).toArrow()
    pairs = zip(top.column("token").to_pylist(), top.column("n").to_pylist())
    return sorted(pairs, key=lambda x: (-x[1], x[0]))


class Vocabulary:
    """The most frequent words with their counts, most frequent first."""

    def __init__(self, words: list[tuple[bytes, int]], tokens: int, types: int, cfg: ModelConfig):
        self.ids = {w: i for i, (w, _) in enumerate(words)}
        self.counts = np.array([n for _, n in words], float)
        self.tokens, self.types, self.head = tokens, types, cfg.head
        head = int(self.counts[: cfg.head].sum())
        in_tail = max(0, types - cfg.head)
        self.base_total = tokens + 0.5 * (types + 1)
        self.tail_total = tokens - head + 0.5 * (in_tail + 1)

    def flat(self, tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all tokens, -1 for words not known; the length of each text; and what
        each token is as context, where a word not known is told by its bytes."""
        words, get = tokens.words, self.ids.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        seen, unknown = ids.copy(), np.flatnonzero(ids < 0)
        seen[unknown] = [UNKNOWN + crc32(words[i]) for i in unknown.tolist()]
        return ids[tokens.codes], tokens.sizes, seen[tokens.codes]


class Weights:
    """Rows of weights of the classes and of the members of a class."""

    def __init__(self, classes: np.ndarray, members: np.ndarray, cfg: ModelConfig):
        self.classes, self.members, self.cfg = classes, members, cfg

    @classmethod
    def empty(cls, cfg: ModelConfig) -> Weights:
        return cls(
            np.zeros((cfg.class_rows, cfg.classes + 1), np.float32),
            np.zeros((cfg.member_rows, cfg.members), np.float32),
            cfg,
        )

    def features(self, seen: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that each token's context selects among classes, and before hashing in its class.

        ``seen`` is what each token is as context; before the first word of a text stands
        a mark.
        """
        mark, starts = -2, np.cumsum(sizes) - sizes
        one, two = np.roll(seen, 1), np.roll(seen, 2)
        if len(seen):
            one[starts] = mark
            two[starts] = mark
            second = starts[sizes > 1] + 1
            two[second] = mark
        keys = np.stack([np.full(len(seen), 1), 4 * one + 18, 4 * two + 19, 4 * (one * 1_000_003 + two) + 20])
        return self._hashed(keys, self.cfg.class_rows), one

    @staticmethod
    def _hashed(keys: np.ndarray, rows: int) -> np.ndarray:
        x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        return (x & np.uint64(rows - 1) if rows & (rows - 1) == 0 else x % np.uint64(rows)).astype(np.int64)

    def member_rows(self, one: np.ndarray, own_class: np.ndarray) -> np.ndarray:
        keys = np.stack([own_class + 7, (one + 3) * 1_048_583 + own_class + 1_000_000_007])
        return self._hashed(keys, self.cfg.member_rows)


def _exponentials(table: np.ndarray, rows: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The numerators of a softmax into ``out``; their sums by row."""
    np.take(table, rows[0], 0, out=out, mode="clip")
    for r in rows[1:]:
        out += table.take(r, 0)
    if out.size and max(out.max(), -out.min()) > 40:  # else no power or sum leaves its range
        out -= out.max(1, keepdims=True)
    np.exp(out, out=out)
    return np.einsum("ij->i", out)


def _softmax(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = np.empty((rows.shape[1], table.shape[1]), table.dtype)
    for at in range(0, len(z), CACHED):
        own = z[at : at + CACHED]
        own /= _exponentials(table, rows[:, at : at + CACHED], own)[:, None]
    return z


def _chances(table: np.ndarray, rows: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The softmax at ``target`` alone."""
    found = np.empty(len(target), table.dtype)
    z = np.empty((min(CACHED, len(target)), table.shape[1]), table.dtype)
    for at in range(0, len(target), CACHED):
        own = target[at : at + CACHED]
        sums = _exponentials(table, rows[:, at : at + CACHED], z[: len(own)])
        found[at : at + CACHED] = z[np.arange(len(own)), own] / sums
    return found


def log_probabilities(
    ids: np.ndarray, sizes: np.ndarray, weights: Weights, seen: np.ndarray | None = None
) -> np.ndarray:
    """log10 P of the class, and for the head of the word in it, of every token."""
    cfg, found = weights.cfg, np.zeros(len(ids))
    rows, one = weights.features(ids if seen is None else seen, sizes)
    in_head = (ids >= 0) & (ids < cfg.head)
    own = np.where(in_head, ids // cfg.members, cfg.classes)
    for at in range(0, len(ids), cfg.batch):
        part = slice(at, at + cfg.batch)
        p = _chances(weights.classes, rows[:, part], own[part])
        found[part] = np.log10(np.maximum(p, 1e-30))
        head = np.flatnonzero(in_head[part])
        of_class = weights.member_rows(one[part][head], own[part][head])
        q = _chances(weights.members, of_class, ids[part][head] % cfg.members)
        found[at + head] += np.log10(np.maximum(q, 1e-30))
    return found


def _in_order(rows: np.ndarray) -> np.ndarray:
    """Stable order of ``rows``, sixteen bits at a time, which numpy sorts fastest."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    if len(rows) and rows.max() >> 16:
        order = order[np.argsort((rows >> 16)[order].astype(np.uint16), kind="stable")]
    return order


def _by_row(rows: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, how often each occurs, and the sum of its errors."""
    if rows[0] == rows[-1] and (rows == rows[0]).all():  # the constant feature
        return rows[:1], np.array([len(rows)]), error.sum(0, keepdims=True)
    order = _in_order(rows)
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    times = np.diff(first, append=len(rows))
    total = error.take(order[first], 0)
    for i in np.flatnonzero(times > FREQUENT).tolist():
        total[i] = error.take(order[first[i] : first[i] + times[i]], 0).sum(0)
    rest, nth = np.flatnonzero((times > 1) & (times <= FREQUENT)), 1
    while len(rest):
        total[rest] += error.take(order[first[rest] + nth], 0)
        nth += 1
        rest = rest[times[rest] > nth]
    return ordered[first], times, total


class Trainer:
    """Steps over one task's documents; remembers what it moved and how often."""

    def __init__(self, weights: Weights):
        self.start = weights
        self.now = Weights(weights.classes.copy(), weights.members.copy(), weights.cfg)
        self.squares = [np.full(len(t), 1e-3, np.float32) for t in (weights.classes, weights.members)]
        self.times = [np.zeros(len(t), np.int64) for t in (weights.classes, weights.members)]

    def _step(self, kind: int, table: np.ndarray, rows: np.ndarray, target: np.ndarray) -> None:
        if not len(target):
            return
        error = _softmax(table, rows)
        error[np.arange(len(error)), target] -= 1
        for r in rows:
            touched, times, gradient = _by_row(r, error)
            squares = self.squares[kind][touched]
            squares += np.einsum("ij,ij->i", gradient, gradient) / np.float32(gradient.shape[1])
            self.squares[kind][touched] = squares
            gradient *= self.start.cfg.rate
            gradient /= np.sqrt(squares)[:, None]
            table[touched] -= gradient
            self.times[kind][touched] += times

    def learn(self, ids: np.ndarray, sizes: np.ndarray, seen: np.ndarray | None = None) -> None:
        cfg = self.start.cfg
        rows, one = self.now.features(ids if seen is None else seen, sizes)
        in_head = (ids >= 0) & (ids < cfg.head)
        own = np.where(in_head, ids // cfg.members, cfg.classes)
        for at in range(0, len(ids), cfg.batch):
            part = slice(at, at + cfg.batch)
            self._step(0, self.now.classes, rows[:, part], own[part])
            head = np.flatnonzero(in_head[part])
            members = self.now.member_rows(one[part][head], own[part][head])
            self._step(1, self.now.members, members, ids[part][head] % cfg.members)

    def moves(self) -> Iterator[tuple[int, int, bytes, bytes]]:
        """(kind, first row, times, times the moves) of ``SENT`` rows, any of them touched."""
        pairs = ((self.start.classes, self.now.classes), (self.start.members, self.now.members))
        for kind, (before, after) in enumerate(pairs):
            for at in range(0, len(before), SENT):
                times = self.times[kind][at : at + SENT]
                if times.any():
                    moved = (after[at : at + SENT] - before[at : at + SENT]) * times[:, None].astype(np.float32)
                    yield kind, at, times.astype("<i8").tobytes(), moved.astype("<f4").tobytes()


_MOVES = pa.schema([("kind", pa.int32()), ("row", pa.int32()), ("times", pa.binary()), ("move", pa.binary())])


def _moves_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(_MOVES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MOVES)], schema=_MOVES)


def _in_batches(rows: Iterator[tuple], most: int = 256) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, most)):
        yield _moves_batch(part)


def _moved(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for kind, row, times, move in zip(*(batch.column(n).to_pylist() for n in _MOVES.names)):
        times = np.frombuffer(times, "<i8")
        yield kind, row, times, np.frombuffer(move, "<f4").reshape(len(times), -1)


def _learning(shared, vocabulary):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, words = Trainer(shared.value), vocabulary.value
        for batch in in_pieces(batches, size=PIECE):
            trainer.learn(*words.flat(tokens_in(batch)))
        yield from _in_batches(trainer.moves())

    return learn


def _summing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by row of a task's share of the rows, which is bounded by the model."""
    sums: dict[tuple[int, int], list[np.ndarray]] = {}
    for batch in batches:
        for kind, row, times, move in _moved(batch):
            if (kind, row) in sums:
                held = sums[kind, row]
                held[0] += times
                held[1] += move
            else:
                sums[kind, row] = [times.copy(), move.astype(np.float64)]
    yield from _in_batches((*k, n.tobytes(), v.astype("<f4").tobytes()) for k, (n, v) in sums.items())


def training_tasks(text_bytes: int, cfg: ModelConfig) -> int:
    """Tasks of a round whose moves take no more bytes than its texts, ``LEAST_TASKS`` at least."""
    return max(LEAST_TASKS, text_bytes // cfg.rounds // cfg.model_bytes)


def train(docs: DataFrame, words: Vocabulary, cfg: ModelConfig, text_bytes: int = 0) -> Weights:
    """Weights after all rounds; they come to the driver, whose size they are bounded by.

    ``text_bytes`` is the size of all texts. A task takes several partitions one after
    the other, if there are more than tasks.
    """
    context = docs.sparkSession.sparkContext
    shape, tasks = "kind int, row int, times binary, move binary", training_tasks(text_bytes, cfg)
    weights, vocabulary = Weights.empty(cfg), context.broadcast(words)
    for number in range(cfg.rounds):
        own = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(cfg.rounds)) == number)
        learn = _learning(context.broadcast(weights), vocabulary)
        moves = own.select("text").coalesce(tasks).mapInArrow(learn, shape).repartition("kind", "row")
        # Written, so that the tasks' moves don't stay on disk for the next round.
        summed = written(moves.mapInArrow(_summing, shape), "moves")
        tables = (weights.classes.copy(), weights.members.copy())
        for kind, row, times, move in _moved(summed.toArrow()):
            tables[kind][row : row + len(times)] += move / np.maximum(times, 1)[:, None]
        removed(summed)
        weights = Weights(*tables, cfg)
    return weights


_SCORES = "number bigint, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, rare array<struct<token:binary,times:int>>"


def _scoring(weights, vocabulary, id_kind: pa.DataType):
    rare_kind = pa.list_(pa.struct([("token", pa.binary()), ("times", pa.int32())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = vocabulary.value, weights.value
        number = TaskContext.get().partitionId() << 40
        base = np.append(np.log10((words.counts + 0.5) / words.base_total), 0.0)
        tail = np.append(np.log10((words.counts + 0.5) / words.tail_total), 0.0)
        tail[: words.head] = 0.0
        tail[-1] = 0.0
        for batch in in_pieces(batches, size=PIECE):
            tokens = tokens_in(batch)
            ids, sizes, seen = words.flat(tokens)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            summed = lambda x: np.bincount(owner, x, len(sizes))
            unknown = np.flatnonzero(ids < 0)
            pairs, times = np.unique(owner[unknown] * len(tokens.words) + tokens.codes[unknown], return_counts=True)
            rare: list[list] = [[] for _ in sizes]
            for doc, word, n in zip(*(x.tolist() for x in (*divmod(pairs, max(1, len(tokens.words))), times))):
                rare[doc].append({"token": tokens.words[word], "times": n})
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number + np.arange(len(sizes))),
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(sizes),
                    pa.array(summed(ids >= 0).astype(np.int64)),
                    pa.array(summed(base[ids])),
                    pa.array(summed(log_probabilities(ids, sizes, model, seen) + tail[ids])),
                    pa.array(rare, rare_kind),
                ],
                names=["number", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"],
            )
            number += len(sizes)

    return score


def score_documents(docs: DataFrame, cfg: ModelConfig = ModelConfig()) -> DataFrame:
    """Base and model score, log10, of every whole text.

    Columns: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    A null text is empty and has its end alone. A row without doc_id is used for
    training. Repeated rows are all counted and each give a row; other columns are
    left out; an empty table gives no rows. Words that no training text has get the
    share of half a count in both scores.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    context = docs.sparkSession.sparkContext
    folded = with_fold(docs, cfg)
    training = folded.filter(~F.col("held_out"))
    counts = written(token_counts(training), "token-counts")
    size = F.sum(F.col("n") * (F.octet_length("token") + 1))
    sizes = counts.agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("types"), size.alias("bytes")).first()
    cfg = cfg.sized(int(sizes["types"]))
    words = Vocabulary(most_frequent(counts, cfg.known), int(sizes["tokens"] or 0), int(sizes["types"]), cfg)
    weights = context.broadcast(train(training, words, cfg, int(sizes["bytes"] or 0)))

    kind = docs.schema["doc_id"].dataType
    shape = _SCORES.format(kind=kind.simpleString())
    score = _scoring(weights, context.broadcast(words), to_arrow_type(kind))
    scored = written(folded.mapInArrow(score, shape), "scores")
    rare = scored.select("number", F.explode("rare").alias("rare"))
    rare = rare.select("number", F.col("rare.token").alias("token"), F.col("rare.times").alias("times"))
    n = F.coalesce("n", F.lit(0))
    missing = rare.join(counts, "token", "left").groupBy("number").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((n + 0.5) / F.lit(words.base_total))).alias("more_base"),
        F.sum(F.col("times") * F.log10((n + 0.5) / F.lit(words.tail_total))).alias("more_score"),
    )
    joined = scored.join(missing, "number", "left")
    added = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0)))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        added("n_known", "more_known").cast("long").alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        added("base", "more_base").alias("base_score"),
        added("score", "more_score").alias("score"),
    )
