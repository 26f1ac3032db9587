"""Language-model scores: a subword lattice over an existing vocabulary, all segmentations weighed."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import staged

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# Passes that fit the scores of the pieces to the training words.
PASSES = 2
# Groups of documents with models of their own have at least this share of the training documents,
# so there are at most 1 / share of them, and one for the rest.
GROUP_SHARE = 1 / 64
# What a piece that was never seen counts for.
SMOOTHING = 0.01
# Words with at least this share of the training tokens are sent to all executors; there are at most
# 1 / share of them, whatever the corpus, and they take at most so many bytes with their scores: the
# share is doubled until they do. The counts of all other words are joined.
HOT_SHARE = 2.0**-20
HOT_BYTES = 1 << 27
# Words of more bytes are scored one by one, with as much memory as the longest piece asks for.
LONG_WORD = 1 << 12
# Words that a task adds up before it sends them on; bytes and number of words that one step lays out.
_COUNTED = 300_000
_CELLS = 400_000
_WORDS = 1 << 16
# Bytes of a long word whose pieces are looked up at once.
_STARTS = 1 << 14


def words_of(text: str | None) -> list[bytes]:
    """Words of a text; A-Z are lower-cased."""
    return (text or "").encode("utf-8", "replace").lower().split()


def load_vocabulary(path: str = VOCABULARY) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece model as bytes, a leading space for the start of a word, and their
    log-probabilities.

    Every single byte is a piece, so every text has a segmentation. Pieces that no lower-cased word
    can have are left out. Models whose scores are ranks get probabilities that fall with the rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores: dict[bytes, float] = {}
    for k in range(model.get_piece_size()):
        if model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
            continue
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            data = bytes([int(piece[1:-1], 16)])
        else:
            data = piece.replace("▁", " ").encode("utf-8")
        if b" " not in data[1:] and data == data.lower():
            scores[data] = max(scores.get(data, -math.inf), model.get_score(k))
    for byte in range(256):
        scores.setdefault(bytes([byte]), min(scores.values(), default=0.0))
    pieces = sorted(scores)
    values = np.array([scores[piece] for piece in pieces])
    if (np.sort(-values)[: len(values) // 2] % 1 == 0).all():
        values = -np.log(np.argsort(np.argsort(-values)) + 10.0)
    return pieces, values - np.logaddexp.reduce(values)


class Lattice:
    """The pieces as a tree of bytes; the ways to write words in pieces.

    `go` holds the next node by node and byte, for nodes that have one, and `piece` the piece that
    ends at a node, or -1; nodes without a next one are numbered behind the others, and -1 is none.
    """

    def __init__(self, go: np.ndarray, piece: np.ndarray, longest: int):
        self.go, self.piece, self.longest = go, piece, longest

    @classmethod
    def of(cls, pieces: list[bytes]) -> Lattice:
        step: dict[int, int] = {}
        piece = [-1]
        for k, data in enumerate(pieces):
            node = 0
            for byte in data:
                node = step.setdefault(node << 8 | byte, len(piece))
                if node == len(piece):
                    piece.append(-1)
            piece[node] = k
        keys, after = np.array(list(step), dtype=np.int64), np.array(list(step.values()), dtype=np.int64)
        inner = np.zeros(len(piece), dtype=bool)
        inner[0] = inner[keys >> 8] = True
        number = np.empty(len(piece), dtype=np.int32)
        number[np.argsort(~inner, kind="stable")] = np.arange(len(piece))
        go = np.full((int(inner.sum()), 256), -1, dtype=np.int32)
        go[number[keys >> 8], keys & 255] = number[after]
        numbered = np.empty(len(piece), dtype=np.int32)
        numbered[number] = piece
        return cls(go, numbered, max(map(len, pieces)))

    @property
    def parts(self) -> tuple[np.ndarray, np.ndarray, int]:
        """What makes the lattice anew elsewhere."""
        return self.go, self.piece, self.longest

    def arcs(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """start, end and piece of all pieces in `data`. A space is the start of a word only, so no
        piece reaches into the next word."""
        flat = np.frombuffer(data + b" ", dtype=np.uint8)
        at = np.arange(len(data))
        node = np.zeros(len(data), dtype=np.int32)
        starts, ends, found = [], [], []
        for depth in range(self.longest):
            node = self.go[node, flat[at + depth]]
            piece = self.piece[node]
            here = (piece >= 0) & (node >= 0)
            starts.append(at[here])
            ends.append(at[here] + depth + 1)
            found.append(piece[here])
            on = (node >= 0) & (node < len(self.go))
            at, node = at[on], node[on]
            if not len(at):
                break
        if not starts:
            return (np.zeros(0, dtype=np.int64),) * 3
        return np.concatenate(starts), np.concatenate(ends), np.concatenate(found).astype(np.int64)

    def batches(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Words of similar length: their indices, sizes, and arcs (word, start, end, piece) by word."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        order = np.argsort(lengths, kind="stable")
        cells = lengths[order] + 2
        at = 0
        while at < len(order):
            room = np.arange(1, min(_WORDS, len(order) - at) + 1) * cells[at : at + _WORDS]
            own = order[at : at + max(1, int(np.searchsorted(room, _CELLS, side="right")))]
            at += len(own)
            sizes = lengths[own] + 1
            first = np.cumsum(sizes) - sizes
            start, end, piece = self.arcs(b"".join(b" " + words[k] for k in own))
            word = np.repeat(np.arange(len(own)), sizes)[start]
            by_word = np.argsort(word.astype(np.uint16), kind="stable")
            yield own, sizes, np.stack([word, start - first[word], end - first[word], piece])[:, by_word]

    def long_word(self, word: bytes, scores: np.ndarray) -> np.ndarray:
        """log-probability of one word by model, as :func:`forward` finds it. Of its prefixes only
        those are held that a piece can still go on from."""
        data = b" " + word
        room = self.longest + 1
        total = np.full((room, scores.shape[1]), -np.inf)
        total[0] = 0
        for base in range(0, len(data), _STARTS):
            starts = min(_STARTS, len(data) - base)
            start, end, piece = self.arcs(data[base : base + starts + self.longest])
            order = np.argsort(start, kind="stable")
            cuts = np.searchsorted(start[order], np.arange(starts + 1))
            for k in range(starts):
                here = total[(base + k) % room].copy()
                total[(base + k) % room] = -np.inf
                own = order[cuts[k] : cuts[k + 1]]
                ends = (base + end[own]) % room
                total[ends] = np.logaddexp(total[ends], here + scores[piece[own]])
        return total[len(data) % room]


def _by(places: np.ndarray) -> np.ndarray:
    """Stable order of arcs by a place in their words. Short words' places sort without comparing."""
    return np.argsort(places.astype(np.int16) if places.max(initial=0) < 1 << 15 else places, kind="stable")


def forward(sizes: np.ndarray, arcs: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """For each prefix of each word, the log-probability of all of its segmentations, by column of
    `scores` (pieces x models)."""
    total = np.full((len(sizes), int(sizes.max()) + 1, scores.shape[1]), -np.inf)
    total[:, 0] = 0
    word, start, end, piece = arcs[:, _by(arcs[2])]  # arcs come by word
    cuts = np.searchsorted(end, np.arange(1, total.shape[1] + 1))
    for j in range(1, total.shape[1]):
        a, b = cuts[j - 1], cuts[j]
        if a == b:
            continue
        values = total[word[a:b], start[a:b]] + scores[piece[a:b]]
        first = np.flatnonzero(np.concatenate([[True], word[a + 1 : b] != word[a : b - 1]]))
        most = np.maximum.reduceat(values, first, axis=0)
        spread = np.repeat(most, np.diff(np.concatenate([first, [b - a]])), axis=0)
        total[word[a:b][first], j] = most + np.log(np.add.reduceat(np.exp(values - spread), first, axis=0))
    return total


def expected(sizes: np.ndarray, arcs: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """How often each piece is expected in one occurrence of each word, summed over the words."""
    total = forward(sizes, arcs, scores[:, None])[:, :, 0]
    cut = np.zeros_like(total)  # the share of segmentations that part a word there
    cut[np.arange(len(sizes)), sizes] = 1
    word, start, end, piece = arcs[:, _by(arcs[1])]
    cuts = np.searchsorted(start, np.arange(total.shape[1] + 1))
    shares = np.zeros(len(word))
    for i in range(total.shape[1] - 1, -1, -1):
        a, b = cuts[i], cuts[i + 1] if i + 1 < len(cuts) else len(word)
        if a == b:
            continue
        shares[a:b] = np.exp(total[word[a:b], i] + scores[piece[a:b]] - total[word[a:b], end[a:b]]) * cut[word[a:b], end[a:b]]
        first = np.flatnonzero(np.concatenate([[True], word[a + 1 : b] != word[a : b - 1]]))
        cut[word[a:b][first], i] = np.add.reduceat(shares[a:b], first)
    return np.bincount(piece, weights=shares, minlength=len(scores))


def word_scores(lattice: Lattice, words: list[bytes], scores: np.ndarray) -> np.ndarray:
    """log-probability of each word (rows) by model (columns), all segmentations weighed."""
    out = np.empty((len(words), scores.shape[1]))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for k in np.flatnonzero(lengths > LONG_WORD):
        out[k] = lattice.long_word(words[k], scores)
    short = np.flatnonzero(lengths <= LONG_WORD)
    for own, sizes, arcs in lattice.batches([words[k] for k in short]):
        out[short[own]] = forward(sizes, arcs, scores)[np.arange(len(own)), sizes]
    return out


def _counted(texts: DataFrame, groups: int) -> DataFrame:
    """word, n, by_group: how often each word occurs. Each task adds up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        counts = [Counter() for _ in range(groups)]

        def out(k: int) -> pa.RecordBatch:
            words, n = list(counts[k]), list(counts[k].values())
            counts[k].clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array([k] * len(words), pa.int32()), pa.array(n, pa.int64())],
                names=["word", "g", "n"],
            )

        for batch in batches:
            for value, k in zip(batch.column(0), batch.column(1).to_pylist()):
                counts[k].update(words_of(value.as_py()))
                if len(counts[k]) * groups >= _COUNTED:
                    yield out(k)
        for k in range(groups):
            yield out(k)

    return (
        texts.select("text", "g")
        .mapInArrow(run, "word binary, g int, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"), *(F.sum(F.when(F.col("g") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(groups)))
        .select("word", "n", F.array(*(f"n{k}" for k in range(groups))).alias("by_group"))
    )


def _lists(column: pa.Array, size: int) -> np.ndarray:
    """Lists of `size` numbers each as rows of floats."""
    return np.asarray(column.flatten(), dtype=float).reshape(-1, size)


def fit(words: DataFrame, groups: int, tree: Broadcast, scores: np.ndarray, passes: int) -> np.ndarray:
    """Log-probabilities of the pieces (rows) for each group of documents (columns).

    Fitted to the different words of each group: the lattice has to foretell new words, and these
    are like rare ones. Each pass weighs all segmentations of all words by the scores so far. What
    reaches the driver is one sum per piece, group and pass.
    """
    scores = np.repeat(scores[:, None], groups, axis=1)
    for _ in range(passes):
        model = words.sparkSession.sparkContext.broadcast(scores)

        def run(batches: Iterator[pa.RecordBatch], model=model) -> Iterable[pa.RecordBatch]:
            scores = model.value
            lattice, counts = Lattice(*tree.value), np.zeros_like(scores)
            for batch in batches:
                words, own = batch.column(0).to_pylist(), _lists(batch.column(1), groups)
                for k in range(counts.shape[1]):
                    for _, sizes, arcs in lattice.batches([words[i] for i in np.flatnonzero(own[:, k])]):
                        counts[:, k] += expected(sizes, arcs, scores[:, k])
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.ravel()[at])], names=["at", "n"])

        found = words.select("word", "by_group").mapInArrow(run, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
        counts = np.full(scores.size, SMOOTHING)
        counts[np.asarray(found.column("at"), dtype=np.int64)] += np.asarray(found.column("n"))
        counts = counts.reshape(scores.shape)
        scores = np.log(counts / counts.sum(axis=0))
        model.unpersist()
    return scores


def _group_names(learned: DataFrame, documents: int) -> list[str]:
    rows = learned.where("g is not null").groupBy("g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= GROUP_SHARE * documents)
    return sorted(row["g"] for row in rows.collect())


def score_texts(
    docs: DataFrame,
    *,
    learn_from: Column | None = None,
    group: str | None = None,
    vocabulary: str = VOCABULARY,
    passes: int = PASSES,
    hot_share: float = HOT_SHARE,
    hot_bytes: int = HOT_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    score is the log10 probability of a text, whose tokens are its words and one end. A word is
    written in pieces of an existing vocabulary; its lattice probability is that of all its
    segmentations, found by a forward recursion in log space. A word seen in training is one more
    arc of its lattice: with c occurrences of it among n tokens of t kinds, its probability is
    (c + t * lattice) / (n + t + 1). The pieces start with the vocabulary's scores, which are fitted
    to the rows where `learn_from` holds (all, by default). If `group` names a column, each of its
    frequent values in training has counts and piece scores of its own, and a text is scored by
    their mixture; the column is not looked at when scoring.

    base_score is that of a word unigram model of the same rows with one added to each count, and
    n_known the number of tokens that it has seen.

    A null text counts as empty: an end alone. Each row is scored for itself, repeated ones and those
    without an id as well. With nothing to learn from, the vocabulary's own scores are used, and the
    base score is 0. Word counts stay distributed: only words too frequent to be many are broadcast,
    `hot_bytes` of them at most; the results do not depend on which. A very long text or word is
    scored whole: scoring a word takes memory for its bytes, fitting to one for its lattice as well.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    content = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    own_group = F.lit(None).cast("string") if group is None else F.col(group).cast("string")
    learned = (docs if learn_from is None else docs.where(learn_from)).select(content, own_group.alias("g"))
    names = _group_names(learned, learned.count())
    groups = len(names) + 1  # the last is for the rest
    number = reduce(lambda rest, k: F.when(F.col("g") == names[k], k).otherwise(rest), range(len(names)), F.lit(len(names)))
    learned = learned.select("text", number.alias("g"))
    documents = np.zeros(groups)
    for row in learned.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect():
        documents[row["g"]] = row["n"]
    words = staged(_counted(learned, groups), "words")
    sums = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)),
        *(F.coalesce(F.sum(F.get("by_group", F.lit(k))), F.lit(0)) for k in range(groups)),
        *(F.count_if(F.get("by_group", F.lit(k)) > 0) for k in range(groups)),
    ).first()
    ends = int(documents.sum())
    tokens, types = sums[0] + ends, sums[1] + (ends > 0)
    own_tokens, own_types = np.array(sums[2 : 2 + groups], float), np.maximum(1.0, np.array(sums[2 + groups :], float))
    whole = own_tokens + documents + own_types + 1
    # Each model's share, and the probability of an end.
    first = np.log10(np.maximum(documents, 1e-300) / max(ends, 1)) + np.log10((documents + 1) / whole)
    if not ends:
        first[-1] = np.log10(1 / whole[-1])
    pieces, scores = load_vocabulary(vocabulary)
    tree = spark.sparkContext.broadcast(Lattice.of(pieces).parts)
    scores = fit(words, groups, tree, scores, passes if ends else 0)
    model = spark.sparkContext.broadcast(scores)
    denominator = math.log10(tokens + types + 1)
    values = [f"v{k}" for k in range(groups)]

    def log_shares(lattice: Lattice, scores: np.ndarray, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        lifted = np.exp(word_scores(lattice, words, scores))
        return np.log10(np.maximum((counts + own_types * lifted) / whole, 1e-300))

    def of_words(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        lattice, scores = Lattice(*tree.value), model.value
        for batch in batches:
            got = log_shares(lattice, scores, batch.column(0).to_pylist(), _lists(batch.column(2), groups))
            columns = [pa.array(np.ascontiguousarray(got[:, k])) for k in range(groups)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=["word", "n", *values])

    least = max(1.0, hot_share * tokens)
    bytes_of = F.octet_length("word") + 8 * (groups + 3)
    while (words.where(F.col("n") >= least).agg(F.sum(bytes_of)).first()[0] or 0) > hot_bytes:
        least *= 2
    frequent = words.where(F.col("n") >= least).mapInArrow(of_words, "word binary, n long, " + ", ".join(f"{v} double" for v in values)).toArrow()
    hot_words = frequent.column("word").to_pylist()
    hot_values = np.array([np.asarray(frequent.column(v)) for v in values]).T.reshape(-1, groups)
    hot_bases = np.log10(np.asarray(frequent.column("n"), dtype=float) + 1) - denominator
    hot = spark.sparkContext.broadcast((hot_words, hot_values, hot_bases))
    kept = ["doc_id long", "n_tokens long", "n_known long", "base double", *(f"{v} double" for v in values)]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        hot_words, hot_values, hot_bases = hot.value
        place = {word: k for k, word in enumerate(hot_words)}
        of_end = math.log10(ends + 1) - denominator
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                tail_row, tail_word, tail_times, of_rows = [], [], [], []
                for row, own_id, text in zip(*(part.column(k).to_pylist() for k in range(3))):
                    own = Counter(words_of(text))
                    at, times = [], []
                    for word, n in own.items():
                        k = place.get(word)
                        if k is None:
                            tail_row.append(row)
                            tail_word.append(word)
                            tail_times.append(n)
                        else:
                            at.append(k)
                            times.append(n)
                    weights = np.array(times, dtype=float)
                    value = first + weights @ hot_values[at] if at else first
                    base = of_end + (float(weights @ hot_bases[at]) if at else 0.0)
                    of_rows.append((row, own_id, sum(own.values()) + 1, sum(times) + (ends > 0), base, value))
                empty = [None] * len(tail_row)
                # No word has a space in it, so these rows find no count; each has a key of its own.
                keys = [b" %d" % x[0] for x in of_rows]
                columns = [pa.array(tail_row + [x[0] for x in of_rows], pa.int64()), pa.array(tail_word + keys, pa.binary())]
                columns.append(pa.array(tail_times + [0] * len(keys), pa.int32()))
                for k, kind in ((1, pa.int64()), (2, pa.int64()), (3, pa.int64()), (4, pa.float64())):
                    columns.append(pa.array(empty + [x[k] for x in of_rows], kind))
                columns += [pa.array(empty + [float(x[5][k]) for x in of_rows], pa.float64()) for k in range(groups)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "word", "times", *(x.split()[0] for x in kept)])

    def rare_words(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        lattice, scores = Lattice(*tree.value), model.value
        for batch in batches:
            times = np.asarray(batch.column("times"))
            at = np.flatnonzero(times)
            n = np.asarray(batch.column("n"))
            base = np.where(times > 0, times * (np.log10(n + 1.0) - denominator), 0.0)
            found = np.zeros((len(times), groups))
            if len(at):
                # Rows come sorted by word: one lattice serves a run of equal words.
                words = batch.column("word").take(pa.array(at)).to_pylist()
                new = np.flatnonzero([True, *(a != b for a, b in zip(words[1:], words))])
                counts = _lists(batch.column("by_group").take(pa.array(at[new])), groups)
                got = log_shares(lattice, scores, [words[k] for k in new], counts)
                found[at] = np.repeat(got, np.diff([*new, len(words)]), axis=0) * times[at][:, None]
            add = lambda name, x: pa.array(np.where(times > 0, x, np.asarray(batch.column(name).fill_null(0))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("n_tokens"), add("n_known", np.where(n > 0, times, 0).astype(np.int64)), add("base", base)]
                + [add(v, found[:, k]) for k, v in enumerate(values)],
                names=["row", *(x.split()[0] for x in kept)],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), content)
    pieces_of_rows = rows.mapInArrow(split, "row long, word binary, times int, " + ", ".join(kept))
    none = F.array(*[F.lit(0).cast("long")] * groups)
    joined = pieces_of_rows.join(words.where(F.col("n") < least), "word", "left").select(
        "row", "word", "times", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("by_group", none).alias("by_group"),
        *(x.split()[0] for x in kept),
    )
    summed = (
        joined.mapInArrow(rare_words, "row long, " + ", ".join(kept))
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.sum("base").alias("base_score"),
            *(F.sum(v).alias(v) for v in values),
        )
    )
    most = F.greatest(*values) if groups > 1 else F.col(values[0])
    mixture = most + F.log10(reduce(lambda a, b: a + b, (F.pow(F.lit(10.0), F.col(v) - most) for v in values)))
    return summed.select(
        "doc_id", "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"), "base_score", mixture.alias("score")
    )
