"""Quality classifier: document evidence, shrunk through host and path.

Two logistic regressions on words and style say how likely a document is of low
quality, or toxic, by its own text. A document's evidence is how far its log odds
lie from the global ones. Hosts (``source``) and paths (``source`` and ``lang``)
have posteriors of their own: the sums of their documents' probabilities, shrunk
towards the level above by as many pseudo-documents as the spread between sites
supports. A document is judged by its evidence on top of its path's posterior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import removed, unused_name, written
from quotelake.llm.tokens import in_pieces
from quotelake.session import bounded_broadcast

TARGETS = ("low_quality", "toxic")

#: ASCII that is neither letter nor digit stands between words.
_GAPS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = b"!#$%&*|<>{}=~^@"
_DIGITS = b"0123456789"
_STEPS = (0.04, 0.1, 0.25, 0.5, 0.8)
#: Numbers of a text's style: five shares and a length, and the steps of the shares.
N_STYLE = 6 + 5 * len(_STEPS)

#: Bytes of a word that are a feature of their own, so that inflected and compound
#: forms of a word count together.
BEGINNING = 4


@dataclass(frozen=True)
class QualityConfig:
    """``part_rows`` is about how many labelled documents one task is fitted on; each has
    its part, and the parts' weights are averaged after ``together`` epochs. A word counts from ``least_share`` of
    all, so at most a document's words divided by that share are weighed, whatever the corpus.
    ``threshold`` is the probability from which a document is rejected;
    ``least_prior`` and ``most_prior`` bound the pseudo-documents of a level."""

    part_rows: int = 8_000
    least_share: float = 0.001
    least_z: float = 7.0
    epochs: int = 12
    together: int = 2
    batch: int = 64
    rate: float = 0.2
    shrink: float = 1e-4
    seed: int = 7
    threshold: float = 0.3
    least_prior: float = 20.0
    most_prior: float = 1e6


def text_features(text: bytes) -> tuple[set[bytes], list[float]]:
    """What a whole text has, and its style.

    It has words, beginnings of longer words, and marks that are one character in
    a hundred or more. Style is a few shares, each as itself and in steps.
    """
    words = text.lower().translate(_GAPS).split()
    different, n, size = set(words), max(1, len(words)), max(1, len(text))
    share = lambda chars: 1 - len(text.translate(None, chars)) / size if text else 0.0
    shares = [share(_UPPER), share(_MARKS), share(_DIGITS), 1 - len(different) / n, 1 / n]
    steps = [float(x >= step) for x in shares for step in _STEPS]
    has = different.union(b"<" + w[:BEGINNING] for w in different if len(w) > BEGINNING)
    if shares[1] >= 0.01:
        has.update(b"mark " + bytes([m]) for m in _MARKS if text.count(m) >= 0.01 * size)
    return has, [*shares, min(1.0, size / n / 20), *steps]


@dataclass(frozen=True)
class Model:
    """Weights of words, of style and of a constant, for each target."""

    words: dict[bytes, int]
    weights: np.ndarray
    style: np.ndarray
    constant: np.ndarray

    def log_odds(self, text: bytes) -> np.ndarray:
        different, style = text_features(text)
        known = [i for i in map(self.words.get, different) if i is not None]
        return self.weights[:, known].sum(1) + self.style @ np.array(style) + self.constant


def telling(features: DataFrame, cfg: QualityConfig) -> list[bytes]:
    """Features that are much more or less frequent where some target holds.

    That is, by ``least_z`` standard errors; all others would only add noise. Counted
    in tasks; at most the sample's features divided by ``least_share`` can remain.
    """
    whole = features.agg(F.count(F.lit(1)).alias("n"), *(F.sum(t).alias(t) for t in TARGETS)).first()
    n = whole["n"]
    counts = features.select(F.explode("has").alias("word"), *TARGETS).groupBy("word")
    counts = counts.agg(F.count(F.lit(1)).alias("total"), *(F.sum(t).alias(t) for t in TARGETS))
    share = F.col("total") / n
    kept = F.lit(False)
    for t in TARGETS:
        yes = whole[t]
        if yes and yes < n:
            error = F.sqrt(share * (1 - share) * (1 / yes + 1 / (n - yes))) + 1e-12
            apart = F.abs(F.col(t) / yes - (F.col("total") - F.col(t)) / (n - yes))
            kept = kept | (apart >= cfg.least_z * error)
    found = counts.filter((F.col("total") >= max(3, cfg.least_share * n)) & kept).select("word")
    return sorted(bytes(r["word"]) for r in found.collect())


def fresh(n_words: int, n_style: int) -> np.ndarray:
    """Weights of words, style and a constant for each target, and sums of squared gradients."""
    width = n_words + n_style + 1
    return np.stack([np.zeros((len(TARGETS), width)), np.full((len(TARGETS), width), 1e-2)])


def train(
    state: np.ndarray,
    rows: list[np.ndarray],
    style: np.ndarray,
    targets: np.ndarray,
    epochs: range,
    cfg: QualityConfig,
) -> np.ndarray:
    """``state`` after some epochs of logistic regressions by AdaGrad over the documents of one part.

    ``rows`` has the places of what each document has.
    """
    weights, squares = state.copy()
    n_words = weights.shape[1] - style.shape[1] - 1
    order = np.random.default_rng(cfg.seed)
    for epoch in range(epochs.stop):
        shuffled = order.permutation(len(rows))
        if epoch < epochs.start:
            continue
        for at in range(0, len(rows), cfg.batch):
            some = shuffled[at : at + cfg.batch]
            own = np.repeat(np.arange(len(some)), [len(rows[i]) for i in some])
            cols = np.concatenate([rows[i] for i in some])
            dense = np.hstack([style[some], np.ones((len(some), 1))])
            for t in range(len(TARGETS)):
                z = np.bincount(own, weights[t, cols], len(some)) + dense @ weights[t, n_words:]
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - targets[some, t]) / len(some)
                touched, place = np.unique(cols, return_inverse=True)
                gradient = np.bincount(place, error[own], len(touched)) + cfg.shrink * weights[t, touched]
                squares[t, touched] += gradient**2
                weights[t, touched] -= cfg.rate * gradient / np.sqrt(squares[t, touched])
                gradient = error @ dense
                squares[t, n_words:] += gradient**2
                weights[t, n_words:] -= cfg.rate * gradient / np.sqrt(squares[t, n_words:])
    return np.stack([weights, squares])


def labelled(labels: DataFrame) -> DataFrame:
    """All labelled ids with their targets.

    An id with several label rows counts as of low quality or toxic if one of them
    says so; labels without id, or without both values, are left out.
    """
    known = labels.filter("doc_id is not null and quality is not null and toxic is not null")
    return known.groupBy("doc_id").agg(
        F.max((F.col("quality") == 0).cast("double")).alias("low_quality"),
        F.max((F.col("toxic") == 1).cast("double")).alias("toxic"),
    )


_LABELLED = ["doc_id", *TARGETS]

#: Documents whose features a worker holds as objects at once.
PIECE_ROWS = 256

#: Most bytes of labels that are broadcast; more meet the documents by a shuffle.
BROADCAST_LABELS = 16 << 20


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_pieces(batches, rows=PIECE_ROWS):
        found = [text_features(t.as_py() or b"") for t in batch.column("text").cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(n) for n in _LABELLED),
                pa.array([list(has) for has, _ in found], pa.list_(pa.binary())),
                pa.array([style for _, style in found], pa.list_(pa.float64())),
            ],
            names=[*_LABELLED, "has", "style"],
        )


def _placed(words: list[bytes]):
    places = {w: i for i, w in enumerate(words)}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_pieces(batches, rows=PIECE_ROWS):
            found = [sorted(places[w] for w in has if w in places) for has in batch.column("has").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in _LABELLED), pa.array(found, pa.list_(pa.int64())), batch.column("style")],
                names=[*_LABELLED, "places", "style"],
            )

    return place


def _part_state(state: np.ndarray, epochs: range, cfg: QualityConfig):
    def fit_part(key_of: tuple, table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, [("doc_id", "ascending")])).combine_chunks()
        places = [np.array(p.as_py(), np.int64) for p in table["places"]]
        style = np.array(table["style"].to_pylist(), float)
        wanted = np.stack([table[t].to_numpy() for t in TARGETS], axis=1)
        found = train(state, places, style, wanted, epochs, cfg)
        kept = {"part": pa.array([key_of[0].as_py()], pa.int32()), "n": pa.array([table.num_rows], pa.int64())}
        return pa.table(kept | {"state": pa.array([found.astype("<f8").tobytes()], pa.binary())})

    return fit_part


def _averaged(states: DataFrame, n: int, shape: tuple[int, ...]) -> np.ndarray:
    """The parts' states, each weighed by its documents; one part after another is read."""
    found = np.zeros(shape)
    for row in states.orderBy("part").toLocalIterator():
        found += np.frombuffer(row["state"], "<f8").reshape(shape) * (row["n"] / n)
    return found


def fit(docs: DataFrame, labels: DataFrame, cfg: QualityConfig) -> Model | None:
    """The model of all labelled documents; None without any.

    A repeated id counts once. Tasks read the texts, and fit a model on each part of the
    documents, dealt by a hash of their ids, from the weights that the parts before had on
    average; the driver gets the telling features and the weights.
    """
    rows = docs.select("doc_id", "text").join(bounded_broadcast(labelled(labels), BROADCAST_LABELS), "doc_id")
    # Only texts of ids that repeat are brought together.
    repeated = written(rows.groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if not repeated.isEmpty():
        each = rows.join(repeated, "doc_id", "left_semi").groupBy("doc_id")
        each = each.agg(*(F.max(c).alias(c) for c in ("text", *TARGETS)))
        rows = rows.join(repeated, "doc_id", "left_anti").unionByName(each)
    kind = docs.schema["doc_id"].dataType.simpleString()
    targets = ", ".join(f"{t} double" for t in TARGETS)
    shape = f"doc_id {kind}, {targets}, has array<binary>, style array<double>"
    features = written(rows.mapInArrow(_features, shape), "features")
    n = features.count()
    if not n:
        removed(features)
        return None
    words = telling(features, cfg)
    shape = f"doc_id {kind}, {targets}, places array<bigint>, style array<double>"
    part = F.pmod(F.xxhash64("doc_id"), F.lit(-(-n // cfg.part_rows))).cast("int").alias("part")
    placed = written(features.mapInArrow(_placed(words), shape), "placed")
    removed(features)
    state = fresh(len(words), N_STYLE)
    for at in range(0, cfg.epochs, cfg.together):
        epochs = range(at, min(at + cfg.together, cfg.epochs))
        states = placed.groupBy(part).applyInArrow(_part_state(state, epochs, cfg), "part int, n bigint, state binary")
        states = written(states, f"states-{at}")
        state = _averaged(states, n, state.shape)
        removed(states)
    removed(placed)
    weights = state[0]
    return Model({w: i for i, w in enumerate(words)}, weights[:, : len(words)], weights[:, len(words) : -1], weights[:, -1])


def _scoring(model: Model | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            if model is None:
                odds = np.full((batch.num_rows, len(TARGETS)), -np.inf)
            else:
                odds = np.array([model.log_odds(t.as_py() or b"") for t in texts]).reshape(-1, len(TARGETS))
            own = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            own[np.isneginf(odds)] = 0.0
            columns = [batch.column(n) for n in ("doc_id", "host", "lang")]
            yield pa.RecordBatch.from_arrays(
                [*columns, *(pa.array(own[:, i]) for i in range(len(TARGETS)))],
                names=["doc_id", "host", "lang", *(f"own_{t}" for t in TARGETS)],
            )

    return score


def _log_odds(p: Column) -> Column:
    bounded = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.log(bounded / (1 - bounded))


def _prior(groups: DataFrame, p: str, cfg: QualityConfig) -> float:
    """Pseudo-documents by the method of moments: little spread, much shrinking."""
    n, total, squares = "n", f"sum_{p}", f"squares_{p}"
    row = groups.agg(
        F.count(n).alias("groups"),
        F.sum(n).alias("rows"),
        F.sum(total).alias("total"),
        F.sum(squares).alias("squares"),
        F.sum(F.col(total) * F.col(total) / F.col(n)).alias("between"),
        F.sum(F.col(n) * F.col(n)).alias("n2"),
    ).first()
    if not row["groups"] or row["groups"] < 2 or row["rows"] <= row["groups"]:
        return cfg.most_prior
    rows, groups_n = float(row["rows"]), row["groups"]
    within = (row["squares"] - row["between"]) / (rows - groups_n)
    mean = row["total"] / rows
    between = row["between"] - rows * mean * mean
    spread = (between - (groups_n - 1) * within) / (rows - float(row["n2"]) / rows)
    if spread <= 0 or within <= 0:
        return cfg.most_prior
    return min(max(within / spread, cfg.least_prior), cfg.most_prior)


def judge(docs: DataFrame, labels: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """One row per document: doc_id, p_low_quality, p_toxic and keep.

    Texts are read whole. A null text is an empty one; a null source or lang is a
    site of its own; documents without doc_id are judged but never used as labelled
    ones; repeated rows are judged alike and each give a row; other columns are
    left out. Without labels every probability is zero and all is kept; an empty
    table gives no rows.
    """
    model = fit(docs, labels, cfg)
    texts = docs.select("doc_id", F.col("source").alias("host"), "lang", "text")
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in texts.schema if f.name != "text"]
    shape = ", ".join([*kinds, *(f"own_{t} double" for t in TARGETS)])
    scored = texts.mapInArrow(_scoring(model), shape)
    scored = written(scored, "scored")

    sums = [F.count(F.lit(1)).alias("n")]
    for t in TARGETS:
        p = F.col(f"own_{t}")
        sums += [F.sum(p).alias(f"sum_{t}"), F.sum(p * p).alias(f"squares_{t}")]
    paths = written(scored.groupBy("host", "lang").agg(*sums), "paths")
    again = [F.sum(c).alias(c) for c in paths.columns if c not in ("host", "lang")]
    hosts = written(paths.groupBy("host").agg(*again), "hosts")
    whole = hosts.agg(*(F.sum(c).alias(c) for c in hosts.columns if c != "host")).first()

    host_rows, path_rows, means = ["host"], ["host", "lang"], {}
    hosts = hosts.withColumnRenamed("n", "host_n")
    for t in TARGETS:
        means[t] = whole[f"sum_{t}"] / whole["n"] if whole["n"] else 0.0
        k = _prior(hosts.withColumnRenamed("host_n", "n"), t, cfg)
        mean = (F.col(f"sum_{t}") + k * means[t]) / (F.col("host_n") + k)
        hosts = hosts.withColumn(f"host_{t}", mean)
        host_rows.append(f"host_{t}")
    same_host = F.col("host").eqNullSafe(F.col("site"))
    above = hosts.select(*host_rows).withColumnRenamed("host", "site")
    joined = paths.join(above, same_host).drop("site")
    for t in TARGETS:
        k = _prior(paths, t, cfg)
        mean = (F.col(f"sum_{t}") + k * F.col(f"host_{t}")) / (F.col("n") + k)
        joined = joined.withColumn(f"path_{t}", mean)
        path_rows.append(f"path_{t}")
    sites = written(joined.select(*path_rows), "sites").select(
        F.col("host").alias("site"), F.col("lang").alias("site_lang"), *path_rows[2:]
    )
    same = F.col("host").eqNullSafe(F.col("site")) & F.col("lang").eqNullSafe(F.col("site_lang"))
    placed = scored.join(sites, same)
    shown = []
    for t in TARGETS:
        evidence = _log_odds(F.col(f"own_{t}")) - _log_odds(F.lit(means[t]))
        posterior = 1 / (1 + F.exp(-(evidence + _log_odds(F.col(f"path_{t}")))))
        shown.append(posterior.alias(f"p_{t}"))
    worst = F.greatest(*(F.col(f"p_{t}") for t in TARGETS))
    return placed.select("doc_id", *shown).select("*", (worst < cfg.threshold).alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    """``docs`` without those rejected; rows without doc_id stay; all columns stay."""
    name = unused_name("rejected", docs.columns)
    rejected = judge(docs, labels, cfg).filter(~F.col("keep")).select(F.col("doc_id").alias(name))
    return docs.join(rejected.distinct(), F.col("doc_id") == F.col(name), "left_anti")
