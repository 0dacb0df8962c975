"""Toxicity by a convolutional text classifier, trained in numpy.

Words (A-Z folded, [0-9a-z] and non-ASCII) are hashed to BUCKETS embeddings (a bucket
knows its word's full hash; any other word has none); filters of one,
two and three words slide over the whole text; each filter's greatest response is kept, and
a logistic unit weighs these. Embeddings begin with the word's log-odds in one coordinate
and small random values in the others; everything is then trained together (Adam).

Training takes every labelled row that is not held out (crc32(doc_id) mod 3 = 1), whole; near
copies among the texts count once. The words' counts are aggregates over all of them. The
texts are dealt by a hash into parts of about PART, each part's task trains the networks
from the same first values, and a network is the mean of what the parts made of it (a
word's embedding: of the parts that moved it). Moves are summed as whole numbers, so the
order of rows changes nothing. Scoring reads every whole text. The model (at most BUCKETS
words) is broadcast.

Thresholds are calibrated by language: the language is guessed from the text's own function
words (never from the lang column), the texts are dealt into FOLDS folds, each text is judged by
networks whose counts and training left its fold out, and a threshold is chosen for each
language on counts of these judgements; the mean of DEALS networks trained on all texts
is shifted so that it lies at 0.7.

A null or empty text is scored as a text without words; a null doc_id is not held out; rows
that repeat are scored alike; labels other than 0 and 1 are ignored and of repeated labels
the greater counts; without labels of both kinds every score is 0; an empty table gives
an empty result; other columns pass through.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays as A
from .tables import drop, read_table, tidy, written

BUCKETS, SIZE, FILTERS, WIDTHS = 1 << 20, 8, 8, (1, 2, 3)  # only owned buckets are stored
PART, PART_CHARS = 4_000, 1 << 25  # texts, and characters, that one task trains on, about
EPOCHS, BATCH, BATCH_WORDS, RATE = 1, 32, 1 << 18, 0.01
PRIOR = 2.0  # texts' weight of the base rate in a word's log-odds
LEAST_TEXTS = 3  # words in fewer have no embedding
CUT = 0.7
MOST_FALSE, LEAST_TOXIC = 0.01, 12  # of other texts rejected, at most; toxic texts that choose a threshold, at least
FOLDS, DEALS = 4, 3  # folds, each judged by networks of the others; networks from different first values
SMALLEST = 8  # hashes of a text's three-word runs by which near copies are known
UNIT, GRID = 1 << 32, 256  # a move of 1, and a logit of 1, as whole numbers
SEED = 11
PAD = max(WIDTHS)  # a text without words is pads alone

# fixed values: frequent function words by language
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for with on as be at by this from or an",
    "de": "der die und das den von zu mit ist im nicht ein eine auf für dem des sich auch als",
    "fr": "le la les et des du une est que qui dans pour pas sur au avec ce il par en",
    "es": "el los las y del que una por con para es se lo como su al más no la de",
}


class Network(NamedTuple):
    embeddings: np.ndarray  # of the model's words; one row more for the pad and all other words
    filters: list[np.ndarray]  # per width: (width, SIZE, FILTERS)
    bias: list[np.ndarray]
    weights: np.ndarray
    offset: float


class Model(NamedTuple):
    prints: np.ndarray  # full hashes of the words that own a bucket, in order of buckets
    networks: list[Network]  # from different first values; their mean judges
    shifts: np.ndarray  # by language, the last for none


def _hashed(column: pa.Array):
    """(first row, rows, word hashes, row offsets) by piece."""
    for first, offsets, buf in A.pieces(column):
        starts, ends, rows = A.words(buf, offsets, A.NOT_ALNUM)
        yield first, len(offsets) - 1, A.span_hashes(buf, starts, ends), rows


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> A.U(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _owned(prints: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Rows of the words' embeddings; the last row for a word that owns no bucket."""
    if len(prints) == 0:
        return np.zeros(len(hashes), np.int64)
    row = np.minimum(np.searchsorted(prints, hashes), len(prints) - 1)
    return np.where(prints[row] == hashes, row, len(prints))


def _function_words() -> list[np.ndarray]:
    return [np.sort(next(_hashed(pa.array([words])))[2]) for words in FUNCTION_WORDS.values()]


def _padded(buckets: np.ndarray, rows: np.ndarray, pad: int):
    """Word rows with PAD pads after each text, and the texts' new starts."""
    n = np.diff(rows)
    start = rows[:-1] + PAD * np.arange(len(n))
    out = np.full(len(buckets) + PAD * (len(n) + 1), pad, dtype=np.int64)
    out[np.arange(len(buckets)) + PAD * A.rows_of(rows)] = buckets
    return out, start, n


def _responses(vectors: np.ndarray, filters: np.ndarray) -> np.ndarray:
    width = len(filters)
    n = len(vectors) - width + 1
    out = vectors[:n] @ filters[0]
    for j in range(1, width):
        out += vectors[j : j + n] @ filters[j]
    return out


def _tops(responses: np.ndarray, start: np.ndarray, n: np.ndarray):
    """Rows x filters: the greatest response of each row, and its first place. A row's positions
    start at its words, or at its first pad if it has none."""
    end = start + np.maximum(n, 1)
    place = np.stack([responses[i:j].argmax(axis=0) for i, j in zip(start.tolist(), end.tolist())]) + start[:, None]
    return np.take_along_axis(responses, place, axis=0), place


def _pooled(network: Network, buckets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows x all filters: greatest response, at least 0."""
    words, start, n = _padded(buckets, rows, len(network.embeddings) - 1)
    vectors = network.embeddings[words]
    out = []
    for filters, bias in zip(network.filters, network.bias):
        all_ = _responses(vectors, filters)
        # a row's positions start at its words, or at its first pad if it has none
        edges = np.stack([start, np.minimum(start + np.maximum(n, 1), len(all_))], axis=1).ravel()
        if edges[-1] >= len(all_):
            edges = edges[:-1]
        out.append(np.maximum.reduceat(all_, edges, axis=0)[::2] + bias)
    return np.maximum(np.concatenate(out, axis=1), 0)


def _language(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Number of each row's language; the last number for none."""
    n = len(rows) - 1
    count = []
    for words in _function_words():
        hit = words[np.minimum(np.searchsorted(words, hashes), len(words) - 1)] == hashes
        count.append(np.bincount(np.searchsorted(rows, np.flatnonzero(hit), side="right") - 1, minlength=n))
    count = np.stack(count, axis=1)
    return np.where(count.max(axis=1) > 0, count.argmax(axis=1), len(FUNCTION_WORDS))


def _logit(p):
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p / (1 - p))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _smallest(words: np.ndarray) -> np.ndarray:
    """The smallest hashes of a text's runs of three words."""
    return np.unique(A.grams(words, min(3, max(len(words), 1))))[:SMALLEST]


def _texts(batches):
    """(batch, row, word hashes) of every text."""
    for batch in batches:
        for first, n, hashes, rows in _hashed(batch.column("text")):
            for i in range(n):
                yield batch, first + i, hashes[rows[i] : rows[i + 1]]


def _sketches(batches):
    A.enter("toxicity: sketches")
    for batch in batches:
        ids, out = [], []
        for _, row, words in _texts([batch]):
            out.append(_smallest(words))
            ids.append(np.full(len(out[-1]), row))
        if ids:
            at = pa.array(np.concatenate(ids))
            n = pa.array(np.concatenate([np.full(len(x), len(x), np.int32) for x in out]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), A.longs(np.concatenate(out)), n], ["doc_id", "hash", "n"])


def _originals(texts: DataFrame) -> DataFrame:
    """Texts that are no near copy of an earlier one (half of their smallest three-word hashes first
    occur in the same one): what copies share by chance is no evidence."""
    key = F.xxhash64("text", F.lit(1)), F.xxhash64("text")
    once = texts.join(texts.groupBy(*key).agg(F.min("doc_id").alias("doc_id")).select("doc_id"), "doc_id", "left_semi")
    sketches = written(once.select("doc_id", "text").mapInArrow(_sketches, "doc_id long, hash long, n int"), "sketches")
    # written before the join: a hash of very many texts can then be split
    holders = written(sketches.groupBy("hash").agg(F.min("doc_id").alias("holder")), "holders")
    shared = sketches.join(holders, "hash").filter("holder < doc_id").groupBy("doc_id", "holder").agg(F.count(F.lit(1)).alias("times"), F.max("n").alias("n"))
    return once.join(shared.filter("2 * times >= n").select("doc_id"), "doc_id", "left_anti")


def _counted(batches):
    """Per batch, word and fold: in how many texts the word is, and in how many toxic ones."""
    A.enter("toxicity: counts")
    for batch in batches:
        fold, toxic = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("fold", "toxic"))
        own, kind = [], []
        for _, row, words in _texts([batch]):
            own.append(np.unique(words))
            kind.append(np.full(len(own[-1]), fold[row] * 2 + toxic[row]))
        if not own:
            continue
        own, kind = np.concatenate(own), np.concatenate(kind)
        order = np.lexsort((kind, own))
        own, kind = own[order], kind[order]
        new = np.ones(len(own), dtype=bool)
        new[1:] = (own[1:] != own[:-1]) | (kind[1:] != kind[:-1])
        times = np.diff(np.append(np.flatnonzero(new), len(own)))
        own, kind = own[new], kind[new]
        yield pa.RecordBatch.from_arrays(
            [A.longs(own), pa.array((kind // 2).astype(np.int32)), pa.array((kind % 2).astype(np.int32)), pa.array(times.astype(np.int64))],
            ["word", "fold", "toxic", "times"],
        )


class Words(NamedTuple):
    prints: np.ndarray  # as of a model
    odds: np.ndarray  # the words' log-odds
    others: int  # texts that are not toxic, and those that are
    toxic: int


def _words(texts: DataFrame, size: dict[tuple[int, int], int]) -> list[Words]:
    """For each fold the words that own a bucket by the texts of the other folds, and at the end by
    all: of the words in enough texts, the one with the strongest odds. At most BUCKETS each."""
    spark, left_out = texts.sparkSession, range(FOLDS + 1)
    n = [[sum(v for (fold, y), v in size.items() if fold != k and y == toxic) for toxic in (0, 1)] for k in left_out]
    base = [max(n1, 1) / (max(n0, 1) + max(n1, 1)) for n0, n1 in n]
    least = [min(LEAST_TEXTS, max(1, (n0 + n1) // 50)) for n0, n1 in n]

    def counted(k: int) -> Column:
        def total(toxic):
            return F.sum(F.when((F.col("fold") != k) & toxic, F.col("times")).otherwise(0))

        return F.struct(F.lit(k).alias("k"), total(F.lit(True)).alias("times"), total(F.col("toxic") == 1).alias("toxic"), F.lit(base[k]).alias("base"), F.lit(least[k]).alias("least"))

    rows = texts.select("text", "fold", "toxic").mapInArrow(_counted, "word long, fold int, toxic int, times long")
    rows = rows.groupBy("word").agg(F.array(*[counted(k) for k in left_out]).alias("c")).select("word", F.inline("c")).filter("times >= least")
    p = (F.col("toxic") + PRIOR * F.col("base")) / (F.col("times") + PRIOR)  # shrunk to the base rate
    p = F.greatest(F.least(p, F.lit(1 - 1e-9)), F.lit(1e-9))
    rows = rows.withColumn("odds", F.log(p / (1 - p)) - F.log(F.col("base") / (1 - F.col("base"))))
    bucket = F.shiftrightunsigned("word", 64 - BUCKETS.bit_length() + 1).alias("bucket")
    best = rows.groupBy("k", bucket).agg(F.max(F.struct(F.abs("odds").alias("strength"), "word", "odds")).alias("best"))
    best = written(best.select("k", "best.word", "best.odds"), "words")
    out = []
    for k in left_out:
        got = best.filter(F.col("k") == k).select("word", "odds").toArrow()  # at most BUCKETS rows
        prints, odds = got["word"].to_numpy().view(np.uint64), got["odds"].to_numpy()
        order = np.argsort(prints)
        out.append(Words(prints[order], odds[order], *n[k]))
    drop(best)
    return out


def _first(words: Words, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A network's first values: embeddings, and the dense parameters."""
    rng = np.random.default_rng(seed)
    pad = len(words.prints)
    E = rng.normal(0, 0.05, (pad + 1, SIZE)).astype(np.float32)
    E[:-1, 0] = words.odds / 2
    E[pad] = 0
    W = [rng.normal(0, 0.3, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in W:
        f[0, 0, : FILTERS // 2] = np.abs(f[0, 0, : FILTERS // 2]) + 0.5
    b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    return E, [*W, *b, np.full(len(WIDTHS) * FILTERS, 0.2, np.float32), np.array([-2.0], np.float32)]


def _network(E: np.ndarray, dense: list[np.ndarray]) -> Network:
    k = len(WIDTHS)
    return Network(E, dense[:k], dense[k : 2 * k], dense[-2], float(dense[-1][0]))


def _batches(order: np.ndarray, docs: list[np.ndarray]):
    """Texts that take a step together: BATCH, or fewer long ones."""
    own, held = [], 0
    for i in order:
        if own and (len(own) == BATCH or held + len(docs[i]) > BATCH_WORDS):
            yield np.array(own)
            own, held = [], 0
        own.append(i)
        held += len(docs[i])
    if own:
        yield np.array(own)


def _fitted(vocabulary: Words, docs: list[np.ndarray], y: np.ndarray, seed: int, number: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """A network trained on the texts of a part (words as rows of the embeddings), from its first values: the rows
    that moved, their moves, and the moves of the dense parameters."""
    rng = np.random.default_rng([seed, number])
    E, dense = _first(vocabulary, seed)
    first_E, first, pad = E.copy(), [p.copy() for p in dense], len(vocabulary.prints)
    W, b = dense[: len(WIDTHS)], dense[len(WIDTHS) : 2 * len(WIDTHS)]
    v, c = dense[-2:]
    m1, m2 = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense]
    e2 = np.zeros(pad + 1, np.float32)
    n0, n1 = vocabulary.others, vocabulary.toxic
    weight = np.where(y == 1, 0.5 * (n0 + n1) / n1, 0.5 * (n0 + n1) / n0)
    step = 0
    for _ in range(EPOCHS):
        for own in _batches(rng.permutation(len(y)), docs):
            step += 1
            rows = np.concatenate([[0], np.cumsum([len(docs[i]) for i in own])])
            words, start, n = _padded(np.concatenate([docs[i] for i in own]), rows, pad)
            vectors = E[words]
            tops, places = [], []
            for f, bias in zip(W, b):
                top, place = _tops(_responses(vectors, f), start, n)
                tops.append(top + bias)
                places.append(place)
            top = np.concatenate(tops, axis=1)
            hidden = np.maximum(top, 0)
            g = ((_sigmoid(hidden @ v + c[0]) - y[own]) * weight[own] / len(own)).astype(np.float32)
            back = g[:, None] * v * (top > 0)
            grads = [None] * len(dense)
            grads[-2], grads[-1] = g @ hidden, np.array([g.sum()])
            touched, values = [], []
            for k, (f, place) in enumerate(zip(W, places)):
                part = back[:, k * FILTERS : (k + 1) * FILTERS]
                grads[len(W) + k] = part.sum(axis=0)
                grads[k] = np.stack([np.einsum("dfs,df->sf", vectors[place + j], part) for j in range(len(f))])
                for j in range(len(f)):
                    touched.append(words[place + j].ravel())
                    values.append((part[:, :, None] * f[j].T[None]).reshape(-1, SIZE))
            for k, (p, gradient) in enumerate(zip(dense, grads)):
                m1[k] = 0.9 * m1[k] + 0.1 * gradient
                m2[k] = 0.999 * m2[k] + 0.001 * gradient * gradient
                p -= RATE * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
            own_rows, where = np.unique(np.concatenate(touched), return_inverse=True)
            total = np.zeros((len(own_rows), SIZE), np.float32)
            np.add.at(total, where, np.concatenate(values))
            total[own_rows == pad] = 0
            e2[own_rows] += (total**2).mean(axis=1)
            E[own_rows] -= 0.02 * RATE * total / (np.sqrt(e2[own_rows]) + 1e-6)[:, None]
    moved = np.flatnonzero(e2)
    return moved, E[moved] - first_E[moved], [p - q for p, q in zip(dense, first)]


_MOVES = [f"v{i}" for i in range(SIZE)]


def _trainer(shared):
    """Trains, on one part of the texts, all networks; gives their moves as whole numbers. Dense
    parameters come as rows -1, -2, ... of SIZE values."""

    def train_part(key, table):
        A.enter("toxicity: training")
        table = table.sort_by("doc_id").combine_chunks()
        words_of = [words for _, _, words in _texts(table.to_batches())]
        every, where = np.unique(np.concatenate(words_of), return_inverse=True)  # looked up once a vocabulary
        edges = np.cumsum([len(words) for words in words_of])[:-1]
        del words_of
        fold, toxic = (table[c].to_numpy().astype(np.int64) for c in ("fold", "toxic"))
        nets, places, moves = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros((0, SIZE), np.int64)]
        for k, vocabulary in enumerate(shared.value):
            take = np.flatnonzero(fold != k)
            if len(take) == 0 or min(vocabulary.others, vocabulary.toxic) == 0:
                continue
            docs = np.split(_owned(vocabulary.prints, every)[where], edges)
            docs = [docs[i] for i in take]
            for deal in range(DEALS):
                rows, moved, dense = _fitted(vocabulary, docs, toxic[take].astype(np.float64), SEED + deal, key[0].as_py())
                flat = np.concatenate([p.ravel() for p in dense])
                flat = np.append(flat, np.zeros(-len(flat) % SIZE, np.float32)).reshape(-1, SIZE)
                places += [rows, -1 - np.arange(len(flat))]
                moves.append(np.rint(np.concatenate([moved, flat]).astype(np.float64) * UNIT).astype(np.int64))
                nets.append(np.full(len(moves[-1]), k * DEALS + deal))
        return pa.table([np.concatenate(nets), np.concatenate(places), *np.concatenate(moves).T], ["net", "place", *_MOVES])

    return train_part


def _mean_network(moves: DataFrame, vocabulary: Words, net: int) -> Network:
    """The first values and the parts' mean moves; at most BUCKETS rows and the dense parameters."""
    got = moves.filter(F.col("net") == net).toArrow()
    place = got["place"].to_numpy()
    mean = np.stack([got[v].to_numpy() for v in _MOVES], axis=1) / UNIT / got["parts"].to_numpy()[:, None]
    E, dense = _first(vocabulary, SEED + net % DEALS)
    E[place[place >= 0]] += mean[place >= 0].astype(np.float32)
    flat = np.zeros((-int(place.min(initial=0)), SIZE), np.float32)
    flat[-1 - place[place < 0]] = mean[place < 0]
    flat, at = flat.ravel(), 0
    for p in dense:
        p += flat[at : at + p.size].reshape(p.shape)
        at += p.size
    return _network(E, dense)


def _judged(networks: list[Network], buckets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Mean logit of the networks for each row of word buckets."""
    return sum(_pooled(net, buckets, rows) @ net.weights + net.offset for net in networks) / len(networks)


def _judgements(texts: DataFrame, prints: np.ndarray, networks: list[Network]) -> np.ndarray:
    """(language, logit, toxic, texts): how many texts the networks judge so, on a grid of logits."""
    shared = texts.sparkSession.sparkContext.broadcast(Model(prints, networks, np.zeros(0)))
    span = 80 * GRID + 1

    def judged(text: pa.Array) -> pa.Array:
        A.enter("toxicity: judgements")
        model, out = shared.value, np.zeros(len(text), np.int32)
        for first, n, hashes, rows in _hashed(text):
            logits = _judged(model.networks, _owned(model.prints, hashes), rows)
            out[first : first + n] = _language(hashes, rows) * span + np.rint((np.clip(logits, -40, 40) + 40) * GRID).astype(np.int64)
        return pa.array(out)

    rows = texts.select("toxic", F.arrow_udf(judged, T.IntegerType())("text").alias("at")).groupBy("toxic", "at").agg(F.count(F.lit(1)).alias("n"))
    got = rows.toArrow()  # at most 2 x languages x span
    shared.destroy()
    at = got["at"].to_numpy().astype(np.int64)
    return np.stack([at // span, at % span / GRID - 40, got["toxic"].to_numpy(), got["n"].to_numpy()], axis=1)


def train(texts: list[str], toxic: list[int]) -> Model | None:
    """The classifier of these texts, or None without texts of both kinds."""
    rows = list(zip(range(len(texts)), texts, map(int, toxic)))
    return _trained(SparkSession.active().createDataFrame(rows, "doc_id long, text string, toxic int").filter("text is not null"))


def _trained(rows: DataFrame) -> Model | None:
    """The classifier of a table of texts (doc_id, which no two share, text, toxic)."""
    with tidy():
        # later steps read the texts again: they are looked up once
        rows = written(rows, "labelled")
        fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)).cast("int")
        texts = written(_originals(rows).withColumn("fold", fold), "originals")
        drop(rows)
        size = texts.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).collect()  # 2 x FOLDS rows
        kinds = [sum(r["n"] for r in size if r["toxic"] == toxic) for toxic in (0, 1)]
        if min(kinds) == 0:
            return None
        parts = max(-(-sum(kinds) // PART), -(-sum(r["chars"] for r in size) // PART_CHARS))
        words = _words(texts, {(r["fold"], r["toxic"]): r["n"] for r in size})
        shared = texts.sparkSession.sparkContext.broadcast(words)
        part = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(parts)).cast("int").alias("part")
        schema = ", ".join(f"{c} long" for c in ("net", "place", *_MOVES))
        moves = texts.select(part, "*").groupBy("part").applyInArrow(_trainer(shared), schema)
        moves = written(moves.groupBy("net", "place").agg(F.count(F.lit(1)).alias("parts"), *[F.sum(v).alias(v) for v in _MOVES]), "moves")
        shared.destroy()

        def networks(k: int) -> tuple[np.ndarray, list[Network]]:
            return words[k].prints, [_mean_network(moves, words[k], k * DEALS + deal) for deal in range(DEALS)]

        prints, final = networks(FOLDS)
        if min(kinds) < 2 * FOLDS:  # too few texts to leave any out
            found = _judgements(texts, prints, final)
        else:
            alone = [min(words[k].others, words[k].toxic) > 0 for k in range(FOLDS)]  # else all texts of a kind are in the fold
            found = np.concatenate([_judgements(texts.filter(F.col("fold") == k), *(networks(k) if alone[k] else (prints, final))) for k in range(FOLDS)])
    model = Model(prints, final, _thresholds(found))
    A.give_back()
    return model


def _thresholds(found: np.ndarray) -> np.ndarray:
    """From counts of (language, logit, toxic, texts), per language: the logit with the least sum of
    both error rates (toxic texts missed, others rejected) at which at most MOST_FALSE of the others
    are rejected; all languages' where one has too few toxic texts."""

    def best(own, least):
        x, where = np.unique(own[:, 1], return_inverse=True)
        toxic, others = (np.bincount(where, weights=own[:, 3] * (own[:, 2] == y), minlength=len(x)) for y in (1, 0))
        if toxic.sum() < least or toxic.sum() == 0 or others.sum() == 0:
            return None
        miss = np.concatenate([[0], np.cumsum(toxic)]) / toxic.sum()
        false = 1 - np.concatenate([[0], np.cumsum(others)]) / others.sum()
        low = int(np.where(false <= MOST_FALSE, miss + false, np.inf).argmin())
        edges = np.concatenate([[x[0] - 1], (x[:-1] + x[1:]) / 2, [x[-1] + 1]])
        return float(edges[low])

    overall = best(found, 1)
    own = [best(found[found[:, 0] == k], LEAST_TOXIC) for k in range(len(FUNCTION_WORDS))]
    return np.array([overall if x is None else x for x in own] + [overall])


def scores(model: Model, texts: pa.Array) -> np.ndarray:
    out = np.zeros(len(texts))
    for first, n, hashes, rows in _hashed(texts):
        logits = _judged(model.networks, _owned(model.prints, hashes), rows)
        out[first : first + n] = _sigmoid(logits - model.shifts[_language(hashes, rows)] + _logit(CUT))
    return out


def remainder(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Train on all labelled texts that are not held out."""
    usable = labels.filter("toxic in (0, 1)").filter(remainder() != 1).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text is not null")
    rows = texts.join(usable, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))  # one, if an id repeats
    return _trained(rows.withColumn("doc_id", F.col("doc_id").cast("long")))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """The input's columns and `score` (0 to 1). Only the texts go to Python, and numbers come back."""
    docs = docs.drop("score")
    if model is None:
        return docs.withColumn("score", F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def toxic(text: pa.Array) -> pa.Array:
        A.enter("toxicity")
        return pa.array(scores(shared.value, text))

    return docs.withColumn("score", F.arrow_udf(toxic, T.DoubleType())(F.col("text").cast("string")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(remainder() == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
