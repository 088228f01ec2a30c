"""Language-model scoring: a log-bilinear model, trained with noise-contrastive estimation in numpy.

The model predicts the class of each token (a frequent word, a kind of rarer word, or the end) from the
two tokens before: their vectors, turned by a matrix for each position, add up to a prediction, whose
product with the vectors of all classes, plus a bias, is normalised. A rarer word is then drawn from its
kind by its smoothed share of the training tokens. So every text has a proper log10 probability.

Counts of all training tokens are summed over the cluster. The training documents, as the classes of their
tokens, are dealt by a hash of the row into shards of SHARD tokens, each in the order of that hash. In each of
ROUNDS rounds every shard trains a copy of the model on its next part, from the same start and with the same
step sizes; the copies and their step sizes are averaged by their tokens, and are the start of the next round.
So the model follows from the rows alone, not from files or tasks. Scoring takes one pass: probabilities come from batched matrix products over the contexts that a batch holds, and words
too many to send to every task are joined with their counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.shared import discard, stored
from meterlake.llm.text import BLANK, chunks, mixed, text_array, words

FOLDS, HELD_OUT = 5, 1
#: Frequent words, kinds of rarer words (by their last byte), and the end.
WORDS, KINDS = 2000, 64
CLASSES = WORDS + KINDS + 1
END_CLASS, START = CLASSES - 1, CLASSES
#: The hash that stands for the end, a token of every text.
END = np.uint64(0xE4D0E4D0E4D0E4D1)
#: Words with at least 1/HEAVY of all training tokens, HEAVY words at most (16 MB), the frequent words and the end
#: are sent to every task.
HEAVY = 1 << 20
WIDTH, NOISE, BATCH, RATE = 24, 64, 1024, 0.08
#: Tokens of a shard, about, and rounds of training and averaging, in which all tokens are gone through once.
SHARD, ROUNDS = 1 << 22, 3
#: Steps that a shard makes in a round, at least: few texts are gone through several times.
LEAST_STEPS = 100
#: Contexts normalised at a time: the scores of all classes then stay in a processor's cache (2 MB).
ROWS = 256


class Model(NamedTuple):
    inputs: np.ndarray  # (CLASSES + 1, WIDTH)
    turns: np.ndarray  # (2, WIDTH, WIDTH)
    outputs: np.ndarray  # (CLASSES, WIDTH)
    bias: np.ndarray


class Counts(NamedTuple):
    heavy: np.ndarray  # sorted hashes
    counts: np.ndarray
    vocabulary: np.ndarray  # sorted hashes of the frequent words
    classes: np.ndarray  # of the vocabulary
    denominator: float
    kind_mass: np.ndarray  # log10 of the base mass of each kind


def tokens(part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, kinds, bounds) of the tokens of the texts, each text with its end."""
    w = words(part, BLANK)
    n = np.diff(w.bounds)
    bounds = np.concatenate([[0], np.cumsum(n + 1)])
    hashes = np.full(bounds[-1], END, np.uint64)
    kinds = np.zeros(bounds[-1], np.int64)
    at = np.arange(len(w.hashes)) + np.repeat(np.arange(len(n)), n)
    hashes[at] = w.hashes
    if len(w.hashes):
        kinds[at] = w.data[w.ends - 1] % KINDS
    return hashes, kinds, bounds


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, kind, n) of the tokens of a batch."""
    for batch in batches:
        found = [tokens(part)[:2] for _, part in chunks(text_array(batch.column("text")))]
        if not found:
            continue
        hashes = np.concatenate([h for h, _ in found])
        kinds = np.concatenate([k for _, k in found])
        unique, first, n = np.unique(hashes, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(unique.view(np.int64)), pa.array(kinds[first].astype(np.int32)), pa.array(n)],
            ["hash", "kind", "n"],
        )


def _classes(hashes: np.ndarray, kinds: np.ndarray, c: Counts) -> np.ndarray:
    out = WORDS + kinds
    if len(c.vocabulary):
        at = np.minimum(np.searchsorted(c.vocabulary, hashes), len(c.vocabulary) - 1)
        out = np.where(c.vocabulary[at] == hashes, c.classes[at], out)
    return np.where(hashes == END, END_CLASS, out)


def _contexts(classes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    before = [np.concatenate([np.full(i, START), classes[:-i]])[: len(classes)] for i in (1, 2)]
    first = bounds[:-1]
    before[0][first], before[1][first] = START, START
    before[1][np.minimum(first + 1, bounds[1:] - 1)] = START
    return before[0], before[1]


def start(unigram: np.ndarray) -> Model:
    random = np.random.default_rng(0)
    turns = np.stack([np.eye(WIDTH), 0.5 * np.eye(WIDTH)])
    return Model(
        random.normal(0, 0.1, (CLASSES + 1, WIDTH)).astype(np.float32),
        turns.astype(np.float32),
        random.normal(0, 0.1, (CLASSES, WIDTH)).astype(np.float32),
        np.log(unigram).astype(np.float32),
    )


def _added_rows(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """The sums of the rows that go to the same place."""
    flat = (at[:, None] * WIDTH + np.arange(WIDTH)).ravel()
    return np.bincount(flat, rows.ravel(), size * WIDTH).reshape(size, WIDTH).astype(np.float32)


def step_sizes(model: Model) -> Model:
    """The sums of squared gradients that a training begins with."""
    return Model(*(np.full(x.shape, 1e-2, np.float32) for x in model))


def train_copy(model: Model, sums: Model, unigram: np.ndarray, one, two, target, seed) -> tuple[Model, Model]:
    """Noise-contrastive estimation with Adagrad: each batch shares its noise words. The model and the sums after it."""
    r, c, q, b = (x.copy() for x in model)
    sums = Model(*(x.copy() for x in sums))
    random = np.random.default_rng(seed)
    log_noise = np.log(NOISE * unigram).astype(np.float32)
    share = np.cumsum(unigram)
    starts = np.arange(0, len(target), BATCH)
    for _ in range(-(-LEAST_STEPS // max(len(starts), 1))):
        for s in random.permutation(starts):
            x1, x2, w = one[s : s + BATCH], two[s : s + BATCH], target[s : s + BATCH]
            noise = np.minimum(np.searchsorted(share, random.random(NOISE)), CLASSES - 1)
            r1, r2 = r[x1], r[x2]
            predicted = r1 @ c[0] + r2 @ c[1]
            true = np.einsum("ij,ij->i", predicted, q[w]) + b[w] - log_noise[w]
            false = predicted @ q[noise].T + (b - log_noise)[noise]
            # Gradients of the log-likelihood, a mean over the batch.
            up = (1 / (1 + np.exp(np.minimum(true, 30)))).astype(np.float32) / len(w)
            down = (-1 / (1 + np.exp(-np.maximum(false, -30)))).astype(np.float32) / len(w)
            grad_p = up[:, None] * q[w] + down @ q[noise]
            drawn = np.concatenate([w, noise])
            grad_q = _added_rows(drawn, np.concatenate([up[:, None] * predicted, down.T @ predicted]), len(q))
            grad_b = np.bincount(drawn, np.concatenate([up, down.sum(axis=0)]), len(b)).astype(np.float32)
            both = np.concatenate([grad_p @ c[0].T, grad_p @ c[1].T])
            grad_r = _added_rows(np.concatenate([x1, x2]), both, len(r))
            grad_c = np.stack([r1.T @ grad_p, r2.T @ grad_p])
            for x, g, total in zip((r, c, q, b), (grad_r, grad_c, grad_q, grad_b), sums, strict=True):
                g = g * NOISE**0.5
                total += g * g
                x += RATE * g / np.sqrt(total)
    return Model(r, c, q, b), sums


def _coded(counts):
    """(shard, key, classes): the classes of each text's tokens, in two bytes each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in chunks(text_array(batch.column("text"))):
                hashes, kinds, bounds = tokens(part)
                classes = _classes(hashes, kinds, counts.value).astype(np.uint16)
                codes = pa.Array.from_buffers(
                    pa.large_binary(),
                    len(part),
                    [None, pa.py_buffer((2 * bounds).astype(np.int64)), pa.py_buffer(classes)],
                )
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, len(part)) for c in ("shard", "key")), codes.cast(pa.binary())],
                    ["shard", "key", "classes"],
                )

    return rows


def _part(texts: list[bytes], number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(one, two, target) of a shard's texts whose first token is in the given part of its tokens."""
    lengths = np.array([len(t) // 2 for t in texts])
    begins = np.cumsum(lengths) - lengths
    here = np.flatnonzero(begins * ROUNDS // max(int(lengths.sum()), 1) == number)
    if not len(here):
        return (np.zeros(0, np.int64),) * 3
    target = np.frombuffer(b"".join(texts[i] for i in here.tolist()), np.uint16).astype(np.int64)
    return *_contexts(target, np.concatenate([[0], np.cumsum(lengths[here])])), target


def _copies(state, unigram, number):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sum of the copies of the task's shards (rows by shard and key), weighted by tokens, in bytes."""
        summed, total = 0.0, 0

        def train(shard: int, texts: list[bytes]) -> None:
            nonlocal summed, total
            one, two, target = _part(texts, number)
            if len(target):
                model, sums = train_copy(*state.value, unigram, one, two, target, [number, shard])
                flat = np.concatenate([x.ravel() for x in (*model, *sums)]).astype(np.float64)
                summed, total = summed + flat * len(target), total + len(target)

        now, texts = None, []
        for batch in batches:
            shards, classes = batch.column("shard").to_numpy(), batch.column("classes").to_pylist()
            edges = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b > a and shards[a] != now:
                    if texts:
                        train(now, texts)
                    now, texts = int(shards[a]), []
                texts += classes[a:b]
        if texts:
            train(now, texts)
        if total:
            for i, piece in enumerate(np.array_split(summed, 16)):
                yield pa.RecordBatch.from_pydict(
                    {"piece": pa.array([i], pa.int32()), "values": [piece.tobytes()], "tokens": [total]}
                )

    return rows


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list] = {}
    for batch in batches:
        for piece, values, n in zip(*(batch.column(c).to_pylist() for c in ("piece", "values", "tokens")), strict=True):
            have = sums.setdefault(piece, [0.0, 0])
            have[0], have[1] = have[0] + np.frombuffer(values), have[1] + n
    for piece, (values, n) in sums.items():
        yield pa.RecordBatch.from_pydict({"piece": pa.array([piece], pa.int32()), "values": [(values / n).tobytes()]})


def trained(rows: DataFrame, counts, unigram: np.ndarray, n_tokens: int) -> Model:
    """The model of the training ``rows`` (doc_id, text), which have so many tokens.

    Rows that repeat id and text are dealt to one shard.
    """
    spark = rows.sparkSession
    key = F.xxhash64("doc_id", "text")
    shards = max(1, -(-n_tokens // SHARD))
    dealt = rows.select(F.pmod(key, F.lit(shards)).alias("shard"), key.alias("key"), "text")
    coded = stored(dealt.mapInArrow(_coded(counts), "shard long, key long, classes binary"), "classes")
    model = start(unigram)
    state = (model, step_sizes(model))
    for number in range(ROUNDS):
        ordered = coded.repartition("shard").sortWithinPartitions("shard", "key")
        copies = ordered.mapInArrow(
            _copies(spark.sparkContext.broadcast(state), unigram, number), "piece int, values binary, tokens long"
        )
        pieces = copies.repartition("piece").mapInArrow(_averaged, "piece int, values binary").collect()
        if pieces:
            flat, out = np.concatenate([np.frombuffer(p.values) for p in sorted(pieces, key=lambda p: p.piece)]), []
            for x in (*state[0], *state[1]):
                out.append(flat[: x.size].reshape(x.shape).astype(np.float32))
                flat = flat[x.size :]
            state = Model(*out[:4]), Model(*out[4:])
    discard(coded)
    return state[0]


def log_probabilities(model: Model, one, two, target, norms: np.ndarray) -> np.ndarray:
    """Normalised log10 probabilities of the targets. ``norms`` keeps what contexts were normalised by."""
    context = one * (CLASSES + 1) + two
    first, second = model.inputs @ model.turns[0], model.inputs @ model.turns[1]
    new = np.unique(context[np.isnan(norms[context])])
    for s in range(0, len(new), ROWS):
        some = new[s : s + ROWS]
        scores = (first[some // (CLASSES + 1)] + second[some % (CLASSES + 1)]) @ model.outputs.T
        scores += model.bias
        most = scores.max(axis=1)
        scores -= most[:, None]
        norms[some] = most + np.log(np.exp(scores, out=scores).sum(axis=1))
    own = np.einsum("ij,ij->i", first[one] + second[two], model.outputs[target]) + model.bias[target]
    return (own - norms[context]).astype(np.float64) / np.log(10)


#: The last model that this process scored with, and what its contexts were normalised by.
_KEPT: list = [None, None]


def _norms_of(model: Model) -> np.ndarray:
    """The norms of the model's contexts. The tasks of a worker have one model, and go on with what was worked out."""
    if _KEPT[0] is not model:
        _KEPT[:] = model, np.full((CLASSES + 1) ** 2, np.nan, np.float32)
    return _KEPT[1]


def _scored(counts, model):
    """Per text one row with what is known in the task, and a row for each other word to be joined."""
    names = ["row", "hash", "n", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, m = counts.value, model.value
        norms = _norms_of(m)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, part in chunks(text_array(batch.column("text"))):
                hashes, kinds, bounds = tokens(part)
                classes = _classes(hashes, kinds, c)
                found = log_probabilities(m, *_contexts(classes, bounds), classes, norms)
                rare = (classes >= WORDS) & (classes < END_CLASS)
                found -= np.where(rare, c.kind_mass[kinds] + np.log10(c.denominator), 0)
                at = np.minimum(np.searchsorted(c.heavy, hashes), max(len(c.heavy) - 1, 0))
                heavy = c.heavy[at] == hashes if len(c.heavy) else np.zeros(len(hashes), bool)
                own = np.where(heavy, np.log10((c.counts[at] if len(c.heavy) else 0) + 0.5), 0)
                found += np.where(rare, own, 0)
                text = np.repeat(np.arange(len(part)), np.diff(bounds))
                sums = [np.bincount(text, x, len(part)) for x in (heavy, own, found)]
                # The other words of each text, once each.
                left = np.flatnonzero(~heavy)
                order = left[np.lexsort((hashes[left], text[left]))]
                h, t = hashes[order], text[order]
                new = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (t[1:] != t[:-1]))) if len(h) else order
                n = np.diff(np.append(new, len(h)))
                h, t = h[new], t[new]
                # A text's own numbers go with its first other word; a text without one gets a row.
                bare = np.setdiff1d(np.arange(len(part)), t)
                h = np.concatenate([h, mixed((row + bare).astype(np.uint64))])
                n, t = np.concatenate([n, np.zeros(len(bare), n.dtype)]), np.concatenate([t, bare])
                lead = np.ones(len(t), bool)
                lead[1:] = t[1:] != t[:-1]
                no = ~lead
                scalars = [
                    pa.array(np.diff(bounds)[t], mask=no),
                    pa.array(sums[0].astype(np.int64)[t], mask=no),
                    pa.array(sums[1][t], mask=no),
                    pa.array(sums[2][t], mask=no),
                ]
                where = pa.array(first + t, mask=no)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + t),
                        pa.array(h.view(np.int64)),
                        pa.array(n),
                        batch.column("doc_id").take(where),
                        batch.column("held_out").take(where),
                        *scalars,
                    ],
                    names,
                )
                row += len(part)

    return rows


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def _counts(known: DataFrame) -> tuple[Counts, int, np.ndarray]:
    """What tasks need of the counts, all training tokens, and the shares of the classes."""
    total = known.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, distinct = int(total.n or 0), total.v
    denominator = n + 0.5 * (distinct + 1)
    end = int(END.astype(np.int64))
    top = known.where(F.col("hash") != end).orderBy(F.desc("n"), "hash").limit(WORDS)
    top = top.select("hash", "kind", "n").toArrow()
    hashes, kind, count = (top.column(c).to_numpy() for c in ("hash", "kind", "n"))
    order = np.argsort(hashes.view(np.uint64))
    heavy = known.where(F.col("n") * HEAVY >= n).select("hash", "n").toArrow()
    ends = known.where(F.col("hash") == end).select("hash", "n").toArrow()
    all_hashes = np.concatenate([heavy.column("hash").to_numpy(), hashes, ends.column("hash").to_numpy()]).view(np.uint64)
    all_hashes, first = np.unique(all_hashes, return_index=True)
    all_counts = np.concatenate([heavy.column("n").to_numpy(), count, ends.column("n").to_numpy()])[first]
    by_kind = known.where(F.col("hash") != end).groupBy("kind")
    mass, kind_tokens = np.zeros(KINDS), np.zeros(KINDS)
    for r in by_kind.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        mass[r.kind], kind_tokens[r.kind] = r.n + 0.5 * r.v, r.n
    np.subtract.at(mass, kind, count + 0.5)
    np.subtract.at(kind_tokens, kind, count)
    # Half a token more stands for all words never seen.
    kind_mass = np.log10((np.maximum(mass, 0) + 0.5) / denominator)
    shares = np.full(CLASSES, 0.5)
    shares[: len(count)] += count
    shares[WORDS : WORDS + KINDS] += kind_tokens
    shares[END_CLASS] += ends.column("n").to_numpy().sum()
    found = Counts(
        all_hashes, all_counts, hashes.view(np.uint64)[order], order, denominator, kind_mass
    )
    return found, n, shares / shares.sum()


def score(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are words without white space, A-Z in lower case, and one end; a null text is an empty one.
    Texts whose crc32(doc_id as text) mod 5 is 1 are held out of all counts and of training; a missing id
    is the empty text there. ``base_score`` sums log10((c+0.5)/(N+0.5(V+1))); ``score`` is the model's
    log10 probability. Repeated rows are trained on and scored one by one; an empty table gives no rows;
    without training texts the model is the uniform start. Other columns are not read. Words are told
    apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        held_out(F.col("doc_id")).alias("held_out"),
    )
    training = rows.where(~F.col("held_out"))
    known = stored(
        training.select("text")
        .mapInArrow(_added, "hash long, kind int, n long")
        .groupBy("hash")
        .agg(F.first("kind").alias("kind"), F.sum("n").alias("n")),
        "token-counts",
    )
    found, train_tokens, unigram = _counts(known)
    counts = spark.sparkContext.broadcast(found)
    model = spark.sparkContext.broadcast(trained(training.select("doc_id", "text"), counts, unigram, train_tokens))
    parts = rows.mapInArrow(
        _scored(counts, model),
        "row long, hash long, n long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
        "score double",
    )
    joined = parts.join(known.select("hash", F.col("n").alias("c")), "hash", "left")
    other = F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5))
    by_row = joined.groupBy("row").agg(
        other.alias("other"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
        *(F.max(c).alias(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "base", "score")),
    )
    return by_row.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.col("known")).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("other") - F.col("n_tokens") * float(np.log10(found.denominator))).alias("base_score"),
        (F.col("score") + F.col("other")).alias("score"),
    )
