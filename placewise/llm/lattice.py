"""Language-model scores that sum over all ways to cut a text into pieces.

The pieces are those of an existing vocabulary. Their probabilities start from its ranks
and are fitted to the words of the training texts by expectation maximisation: each word
is a lattice of pieces, the forward and backward sums weigh all paths, and each piece gets
what its arcs carry. The score of a text is the marginal probability of its words, each
with its leading space, and of an end: the forward sum over every segmentation. Pieces do
not reach across spaces, so the sum over a text is the product over its words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placewise.llm.texts import LOWER, Words, arrow_map, slices
from placewise.session import work_folder

# Rounds of expectation maximisation, and what each piece gets beside its expected count.
ROUNDS, SMOOTHING = 2, 0.1
# Words that are broadcast with their scores, at most: the most frequent of up to LONG_WORD bytes. All others are joined.
HEAD_WORDS = 100_000
# Distinct words that a task counts before it sends them.
HELD_WORDS = 400_000
# Words up to LONG_WORD bytes are scored TOGETHER by length, longer ones one by one.
LONG_WORD, TOGETHER = 64, 8192
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# The end of a text, as a word: no word is empty.
END = b""
SPACE = "▁".encode()


@dataclass(frozen=True)
class Pieces:
    """Log probabilities of pieces, and of the end of a text."""

    log: dict[bytes, float]
    end: float
    longest: int

    def forward(self, data: bytes) -> list[float]:
        """The log of the summed probability of all paths to each byte; bytes are pieces too, so none is out of reach."""
        sums, log, longest = [0.0], self.log, self.longest
        for end in range(1, len(data) + 1):
            best, terms = -math.inf, []
            for start in range(max(0, end - longest), end):
                weight = log.get(data[start:end])
                if weight is not None:
                    term = sums[start] + weight
                    terms.append(term)
                    if term > best:
                        best = term
            sums.append(best if len(terms) == 1 else best + math.log(sum(math.exp(t - best) for t in terms)))
        return sums

    def expected(self, data: bytes, count: float, into: dict[bytes, float]) -> None:
        """Adds what each piece carries in ``count`` words."""
        forward, log, longest, size = self.forward(data), self.log, self.longest, len(data)
        backward = [0.0] * (size + 1)
        for start in range(size - 1, -1, -1):
            terms = [backward[end] + log[data[start:end]] for end in range(start + 1, min(size, start + longest) + 1) if data[start:end] in log]
            best = max(terms)
            backward[start] = best + math.log(sum(math.exp(t - best) for t in terms))
        for start in range(size):
            for end in range(start + 1, min(size, start + longest) + 1):
                piece = data[start:end]
                if piece in log:
                    into[piece] = into.get(piece, 0.0) + count * math.exp(forward[start] + log[piece] + backward[end] - forward[size])

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Hashes of the pieces in ascending order, their log probabilities, and the pieces."""
        names = list(self.log)
        hashes = np.array([_hash(name) for name in names], np.uint64)
        order = np.argsort(hashes)
        return hashes[order], np.array(list(self.log.values()))[order], [names[i] for i in order.tolist()]

    def _arcs(self, letters: np.ndarray):
        """``start, end, words, pieces`` for words of one length, a row of bytes each, by ascending start."""
        hashes, _, _ = self.table
        size = letters.shape[1]
        for start in range(size):
            own = np.zeros(len(letters), np.uint64)
            for end in range(start + 1, min(size, start + self.longest) + 1):
                own = own * _FACTOR + (letters[:, end - 1] + np.uint64(1))
                at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                found = np.flatnonzero(hashes[at] == own)
                if len(found):
                    yield start, end, found, at[found]

    def words(self, words: list[bytes]) -> np.ndarray:
        """log10 of the marginal probability of each word: all words of one length at once."""
        result = np.empty(len(words))
        weights = self.table[1]
        for size, places in _by_length(words):
            if size > LONG_WORD:
                result[places] = [self.forward(SPACE + words[i])[-1] for i in places]
                continue
            letters = _letters(words, places, size)
            sums = np.full((letters.shape[1] + 1, len(places)), -np.inf)
            sums[0] = 0.0
            for start, end, found, at in self._arcs(letters):
                sums[end, found] = np.logaddexp(sums[end, found], sums[start, found] + weights[at])
            result[places] = sums[-1]
        return result / math.log(10)

    def carried(self, words: list[bytes], counts: np.ndarray) -> dict[bytes, float]:
        """What each piece carries in the words, each counted so often."""
        _, weights, names = self.table
        total, long = np.zeros(len(names)), {}
        for size, places in _by_length(words):
            if size > LONG_WORD:
                for i in places:
                    self.expected(SPACE + words[i], float(counts[i]), long)
                continue
            letters = _letters(words, places, size)
            forward = np.full((letters.shape[1] + 1, len(places)), -np.inf)
            forward[0] = 0.0
            backward = np.full_like(forward, -np.inf)
            backward[-1] = 0.0
            arcs = list(self._arcs(letters))
            for start, end, found, at in arcs:
                forward[end, found] = np.logaddexp(forward[end, found], forward[start, found] + weights[at])
            for start, end, found, at in reversed(arcs):
                backward[start, found] = np.logaddexp(backward[start, found], backward[end, found] + weights[at])
            n = counts[places]
            for start, end, found, at in arcs:
                share = np.exp(forward[start, found] + weights[at] + backward[end, found] - forward[-1, found])
                total += np.bincount(at, n[found] * share, minlength=len(total))
        result = {names[i]: float(total[i]) for i in np.flatnonzero(total).tolist()}
        for piece, n in long.items():
            result[piece] = result.get(piece, 0.0) + n
        return result

    def ending(self) -> float:
        """log10 of the probability of an end."""
        return self.end / math.log(10)


def _hash(piece: bytes) -> int:
    value = 0
    for byte in piece:
        value = (value * int(_FACTOR) + byte + 1) & 0xFFFFFFFFFFFFFFFF
    return value


def _by_length(words: list[bytes]):
    """``length, places`` of the words of each length, some thousand at a time."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    bounds = np.append(0, np.flatnonzero(np.diff(sizes[order])) + 1)
    for a, b in zip(bounds, np.append(bounds[1:], len(order)), strict=True):
        for start in range(a, b, TOGETHER):
            yield int(sizes[order[a]]), order[start:min(b, start + TOGETHER)].tolist()


def _letters(words: list[bytes], places: list[int], size: int) -> np.ndarray:
    joined = b"".join(SPACE + words[i] for i in places)
    return np.frombuffer(joined, np.uint8).reshape(len(places), size + len(SPACE)).astype(np.uint64)


def vocabulary(path: str) -> Pieces:
    """The pieces of a sentencepiece model and single bytes. By its ranks, a piece of rank r starts in proportion to 1 / (r + 100)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranks: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            ranks.setdefault(bytes([int(model.id_to_piece(i)[3:-1], 16)]), model.get_piece_size())
        elif not (model.is_control(i) or model.is_unknown(i)):
            ranks[model.id_to_piece(i).encode()] = min(-model.get_score(i), model.get_piece_size())
    weights = {piece: 1 / (rank + 100) for piece, rank in ranks.items()}
    total = math.log(sum(weights.values()))
    return Pieces({piece: math.log(w) - total for piece, w in weights.items()}, 0.0, max(map(len, weights)))


def counted(rows: DataFrame) -> DataFrame:
    """``word, n, seen``: all words of the texts, and an end for each; how often in texts to ``learn`` from, and in all."""
    def run(batches):
        held: dict[bytes, list[int]] = {}
        learnt = ends = 0

        def sent():
            return {"word": list(held), "n": [x[0] for x in held.values()], "seen": [x[1] for x in held.values()]}

        for batch, slice_ in slices(batches):
            words = Words(slice_, mapped=LOWER)
            codes, distinct = words.coded()
            learn = batch.column("learn").to_numpy(zero_copy_only=False)
            n = np.bincount(codes[learn[words.owners()]], minlength=len(distinct)).tolist()
            for word, own, all_ in zip(distinct.to_pylist(), n, np.bincount(codes, minlength=len(distinct)).tolist(), strict=True):
                both = held.setdefault(word, [0, 0])
                both[0] += own
                both[1] += all_
            learnt += int(learn.sum())
            ends += batch.num_rows
            if len(held) > HELD_WORDS:
                yield sent()
                held.clear()
        if ends:
            held[END] = [learnt, ends]
            yield sent()

    found = arrow_map(rows, run, "word binary, n long, seen long").groupBy("word")
    return found.agg(F.sum("n").alias("n"), F.sum("seen").alias("seen"))


def fitted(counts: DataFrame, start: Pieces, rounds: int = ROUNDS) -> Pieces:
    """Piece probabilities for the counted words: all words take part, and what comes back is a number for each piece."""
    spark, pieces = counts.sparkSession, start
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(pieces)

        def run(batches, model=model):
            found: dict[bytes, float] = {}
            for batch in batches:
                words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy().astype(np.float64)
                ends = np.array([word == END for word in words], bool)
                own = model.value.carried([w for w in words if w != END], n[~ends])
                own[END] = float(n[ends].sum())
                for piece, carried in own.items():
                    found[piece] = found.get(piece, 0.0) + carried
            yield {"piece": list(found), "n": list(found.values())}

        sums = {bytes(r["piece"]): r["n"] for r in arrow_map(counts, run, "piece binary, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()}
        ends = sums.pop(END, 0.0) + SMOOTHING
        total = math.log(sum(sums.values()) + SMOOTHING * len(start.log) + ends)
        pieces = Pieces({p: math.log(sums.get(p, 0.0) + SMOOTHING) - total for p in start.log}, math.log(ends) - total, start.longest)
    return pieces


def weighed(counts: DataFrame, pieces: Pieces, total: int, distinct: int) -> DataFrame:
    """``word, n, seen, base, lattice``: the scores of each distinct word, worked out once for all texts."""
    model, below = counts.sparkSession.sparkContext.broadcast(pieces), total + 0.5 * (distinct + 1)

    def run(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            lattice = model.value.words(words)
            lattice[[word == END for word in words]] = model.value.ending()
            base = np.log10((batch.column("n").to_numpy() + 0.5) / below)
            yield {"word": batch.column("word"), "n": batch.column("n"), "seen": batch.column("seen"), "base": base, "lattice": lattice}

    return arrow_map(counts, run, "word binary, n long, seen long, base double, lattice double")


def _scores(head):
    """Rows ``doc_id`` with sums over the words of the head, and the other words with how often they occur."""
    def run(batches):
        known = head.value
        end = known[END]
        for batch, texts in slices(batches):
            words = Words(texts, mapped=LOWER)
            codes, distinct = words.coded()
            names = distinct.to_pylist()
            values = np.zeros((3, len(names)))
            missing = np.ones(len(names), bool)
            for i, name in enumerate(names):
                found = known.get(name)
                if found:
                    values[:, i], missing[i] = found, False
            sums = lambda x: np.diff(np.append(0, np.cumsum(x[codes]))[words.first])
            rest, counts = [], []
            at = np.append(0, np.cumsum(missing[codes]))[words.first]
            others = codes[missing[codes]]
            for a, b in zip(at[:-1], at[1:], strict=True):
                own, n = np.unique(others[a:b], return_counts=True)
                rest.append([names[i] for i in own.tolist()])
                counts.append(n.tolist())
            yield {"doc_id": batch.column("doc_id"), "row": batch.column("row"), "n_tokens": words.counts + 1,
                   "n_known": (sums(values[0]) + end[0]).round().astype(np.int64), "base": sums(values[1]) + end[1], "score": sums(values[2]) + end[2],
                   "words": rest, "counts": counts}
    return run


def _head_count(counts: DataFrame) -> int:
    """The least that a word of the head is seen; the head has HEAD_WORDS words at most: all words of one size class are in it or none."""
    size = F.floor(F.log2("seen") * 16).alias("size")
    sizes = counts.groupBy(size).agg(F.count("*").alias("words"), F.min("seen").alias("least")).orderBy(F.desc("size")).collect()
    words, least = 0, 1 << 62
    for r in sizes:
        words += r["words"]
        if words > HEAD_WORDS:
            break
        least = r["least"]
    return least


def scored(docs: DataFrame, learn: Column, vocabulary_path: str) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of each row of ``docs``.

    Rows for which ``learn`` holds are learnt from, all are scored. Tokens are the words,
    A-Z lower-cased, and an end. ``base_score`` sums log10((c + 0.5) / (N + 0.5 (V + 1)))
    over the tokens, ``score`` is the log10 of the marginal probability. A null text has an
    end alone. Rows are scored each by itself, equal ids or none notwithstanding; other
    columns are not read. With nothing to learn from N and V are 0.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "lattice")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    counted(rows.select("text", "learn")).write.parquet(f"{folder}/counts")
    counts = spark.read.schema("word binary, n long, seen long").parquet(f"{folder}/counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    pieces = fitted(counts.where("n > 0").select("word", "n"), vocabulary(vocabulary_path))
    weighed(counts, pieces, total, distinct).write.parquet(f"{folder}/words")
    words = spark.read.schema("word binary, n long, seen long, base double, lattice double").parquet(f"{folder}/words")
    frequent = (F.col("seen") >= _head_count(words)) & (F.length("word") <= LONG_WORD) | (F.col("word") == F.lit(END))
    head = {bytes(r["word"]): (float(r["n"] > 0), r["base"], r["lattice"]) for r in words.where(frequent).select("word", "n", "base", "lattice").collect()}
    run = _scores(spark.sparkContext.broadcast(head))
    kind = "doc_id long, row long, n_tokens long, n_known long, base double, score double, words array<binary>, counts array<int>"
    texts = rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))
    arrow_map(texts, run, kind).write.parquet(f"{folder}/scores")
    found = spark.read.schema(kind).parquet(f"{folder}/scores")
    rest = (found.select("row", "doc_id", F.explode(F.arrays_zip("words", "counts")).alias("w"))
            .select("row", "doc_id", F.col("w.words").alias("word"), F.col("w.counts").alias("times")).distinct().join(words, "word"))
    sums = rest.groupBy("row", F.col("doc_id").alias("of")).agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.col("base")).alias("more_base"), F.sum(F.col("times") * F.col("lattice")).alias("more_score"))
    sums = sums.withColumnRenamed("row", "of_row")
    more = lambda c: F.coalesce(F.col(f"more_{c}"), F.lit(0))
    return (found.select("doc_id", "row", "n_tokens", "n_known", "base", "score")
            .join(sums, (F.col("row") == F.col("of_row")) & F.col("doc_id").eqNullSafe(F.col("of")), "left")
            .select("doc_id", "n_tokens", (F.col("n_known") + more("known")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("base") + more("base")).alias("base_score"), (F.col("score") + more("score")).alias("score")))
