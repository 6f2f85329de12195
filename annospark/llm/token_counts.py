"""Token counts of a unigram vocabulary by dynamic programming over a trie of distinct words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annospark.llm.common import bounds, byte_texts, staged, text_slices, unstage

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"  # stands before each word, as the blank does in the vocabulary
#: Words that a task holds before it starts anew.
MAX_WORDS = 400_000
#: A character outside all pieces is spelt in bytes, each a token of this score.
BYTE_SCORE = -20.0
#: Rounds of estimating the pieces' probabilities, and what is added to each piece's count.
ROUNDS = 2
SMOOTHING = 0.5
#: Longer words share no prefix worth a level of the trie each; they are counted one by one.
MAX_TRIE = 256


@lru_cache(maxsize=2)
def vocabulary(path: str = VOCABULARY) -> list[str]:
    """The pieces with a text of their own, in the file's order: no control, unknown, byte and unused pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return [p for i in ids if (p := model.id_to_piece(i)).strip(MARK) or p == MARK]


def rank_scores(path: str = VOCABULARY) -> np.ndarray:
    """First guess of each piece's log probability: the file ranks its pieces, and rank r gets that of Zipf's law, 1 / (r + 2)."""
    weight = 1 / np.arange(2.0, len(vocabulary(path)) + 2)
    return np.log(weight / weight.sum())


class _Pieces:
    """The vocabulary as a trie of states. ``piece`` has the piece that ends in a state, or -1."""

    def __init__(self, path: str):
        self.pieces = vocabulary(path)
        states = {"": 0}
        keys, targets = [], []
        for piece in sorted(self.pieces):
            for n in range(1, len(piece) + 1):
                if piece[:n] not in states:
                    states[piece[:n]] = len(states)
                    keys.append(states[piece[: n - 1]] << 21 | ord(piece[n - 1]))
                    targets.append(states[piece[:n]])
        order = np.argsort(keys)
        self.keys, self.targets = np.array(keys, np.int64)[order], np.array(targets, np.int64)[order]
        self.ascii = np.full((len(states), 128), -1, np.int32)
        low = (self.keys & ((1 << 21) - 1)) < 128
        self.ascii[self.keys[low] >> 21, self.keys[low] & 127] = self.targets[low]
        self.piece = np.full(len(states), -1)
        self.piece[[states[p] for p in self.pieces]] = np.arange(len(self.pieces))
        self.longest = max(map(len, self.pieces), default=0)

    def step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is none."""
        found = self.ascii[state, char & 127].astype(np.int64)
        if len(wide := np.flatnonzero(char > 127)):
            key = state[wide] << 21 | char[wide]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found[wide] = np.where(self.keys[at] == key, self.targets[at], -1)
        return found


@lru_cache(maxsize=2)
def _pieces(path: str) -> _Pieces:
    return _Pieces(path)


def _spelt(letter: np.ndarray) -> np.ndarray:
    """Bytes of each character."""
    return 1 + (letter > 0x7F).astype(np.int64) + (letter > 0x7FF) + (letter > 0xFFFF)


@dataclass
class _Level:
    """The nodes of one level: of each the piece that its best segmentation ends with (-1: bytes) and the node before that piece."""

    piece: np.ndarray
    before: np.ndarray


class Segmenter:
    """Best segmentations of distinct words under piece scores (log probabilities in the vocabulary's order)."""

    def __init__(self, scores: np.ndarray, path: str = VOCABULARY):
        self.pieces, self.scores = _pieces(path), scores

    def count(self, words: list[str]) -> np.ndarray:
        """How many tokens the best segmentation of each of the distinct ``words`` has."""
        return self._run(words, None)

    def uses(self, words: list[str], weights: np.ndarray) -> np.ndarray:
        """How often the best segmentations use each piece; each word counts ``weights`` times."""
        found = np.zeros(len(self.scores))
        self._run(words, weights, found)
        return found

    def _run(self, words: list[str], weights: np.ndarray | None, uses: np.ndarray | None = None) -> np.ndarray:
        result = np.zeros(len(words), np.int64)
        short = [i for i, w in enumerate(words) if len(w) < MAX_TRIE]
        if short:
            result[short] = self._trie([words[i] for i in short], None if weights is None else weights[short], uses)
        if len(short) < len(words):
            for i in (i for i, w in enumerate(words) if len(w) >= MAX_TRIE):
                result[i] = self._alone(words[i], 1 if weights is None else weights[i], uses)
        return result

    def _trie(self, words: list[str], weights: np.ndarray | None, uses: np.ndarray | None) -> np.ndarray:
        """The words form a trie. Level by level, the best score of each node (a prefix that words share) is the largest of
        score(node before the piece) + score(piece) over the pieces that end there; it is computed once for all words
        below it. Each word reads its count at its terminal node. Of equal scores the one with fewer tokens counts. How often
        pieces are used flows back from the terminal nodes, once per shared prefix."""
        pieces = self.pieces
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        marked = [MARK + words[i] for i in order.tolist()]
        size = np.fromiter(map(len, marked), np.int64, len(marked))
        chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        first = bounds(size)[:-1]
        result = np.zeros(len(words), np.int64)
        node = np.zeros(len(words), np.int64)  # of each word that reaches this level
        live = np.arange(len(words))
        score, tokens = np.zeros(1), np.zeros(1, np.int64)  # of the nodes of this level
        # partial pieces: node of this level they reach, their state, and score, tokens and node where they began
        at, state, base, base_n, origin = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.int64)
        levels, ends_at, n_before, depth = [], [], 0, 0  # nodes are numbered through all levels; the root is 0
        while len(live):
            char = chars[first[live] + depth]
            new = np.ones(len(live), bool)
            new[1:] = (node[1:] != node[:-1]) | (char[1:] != char[:-1])
            parent, letter = node[new], char[new]
            node = np.cumsum(new) - 1
            n_nodes = len(parent)
            # each partial piece of a parent goes on to each child
            begin = np.searchsorted(at, parent, "left")
            many = np.searchsorted(at, parent, "right") - begin
            child = np.repeat(np.arange(n_nodes), many)
            source = np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(len(child))
            state = pieces.step(state[source], letter[child])
            on = np.flatnonzero(state >= 0)
            child, state, source = child[on], state[on], source[on]
            base, base_n, origin = base[source], base_n[source], origin[source]
            # the pieces that end here, and the spelling of the character in bytes
            spelt = _spelt(letter)
            best, best_n = score[parent] + BYTE_SCORE * spelt, tokens[parent] + spelt
            best_piece, best_before = np.full(n_nodes, -1), n_before + parent
            piece = pieces.piece[state]
            ends = np.flatnonzero(piece >= 0)
            if len(ends):
                to, value, count = child[ends], base[ends] + self.scores[piece[ends]], base_n[ends] + 1
                run = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
                most = np.maximum.reduceat(value, run)
                length = np.diff(np.append(run, len(to)))
                top = value == np.repeat(most, length)
                fewest = np.minimum.reduceat(np.where(top, count, 1 << 60), run)
                pick = np.flatnonzero(top & (count == np.repeat(fewest, length)))
                pick = pick[np.append(True, to[pick][1:] != to[pick][:-1])]  # of equal ones the longest piece
                k, value, count = to[pick], value[pick], count[pick]
                better = (value > best[k]) | ((value == best[k]) & (count < best_n[k]))
                k, pick = k[better], pick[better]
                best[k], best_n[k] = value[better], count[better]
                best_piece[k], best_before[k] = piece[ends[pick]], origin[ends[pick]]
            score, tokens = best, best_n
            n_before = n_before + (len(levels[-1].piece) if levels else 1)
            levels.append(_Level(best_piece, best_before))
            depth += 1
            # words that end read their terminal
            over = size[live] == depth
            result[order[live[over]]] = tokens[node[over]]
            if uses is not None:
                ends_at.append((n_before + node[over], order[live[over]]))
            live, node = live[~over], node[~over]
            at = np.concatenate([child, np.arange(n_nodes)])
            turn = np.argsort(at, kind="stable")
            at = at[turn]
            state = np.concatenate([state, np.zeros(n_nodes, np.int64)])[turn]
            base, base_n = np.concatenate([base, score])[turn], np.concatenate([base_n, tokens])[turn]
            origin = np.concatenate([origin, n_before + np.arange(n_nodes)])[turn]
        if uses is not None and levels:
            flow = np.zeros(n_before + len(levels[-1].piece))
            for k, i in ends_at:
                np.add.at(flow, k, weights[i])
            top = len(flow)
            for level in reversed(levels):
                own = flow[top - len(level.piece) : top]
                used = level.piece >= 0
                uses += np.bincount(level.piece[used], own[used], len(uses))
                np.add.at(flow, level.before, own)
                top -= len(level.piece)
        return result

    @property
    def _nested(self) -> dict:
        """The trie as nested tables: character -> [piece or -1, table]."""
        if not hasattr(self, "_tables"):
            self._tables: dict = {}
            for i, piece in enumerate(self.pieces.pieces):
                table, entry = self._tables, None
                for c in piece:
                    entry = table.setdefault(c, [-1, {}])
                    table = entry[1]
                entry[0] = i
        return self._tables

    def _alone(self, word: str, weight: float, uses: np.ndarray | None) -> int:
        """The same for one word, in time that grows with its length."""
        word, nested, scores = MARK + word, self._nested, self.scores.tolist()
        spelt = _spelt(np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)).tolist()
        n = len(word)
        score, tokens, piece, before = [0.0] + [-np.inf] * n, [0] * (n + 1), [-1] * (n + 1), [0] * (n + 1)
        for i in range(n):
            own, count = score[i], tokens[i]
            # longer pieces came first; bytes must be better than they are, or as good with fewer tokens
            value, k = own + BYTE_SCORE * spelt[i], count + spelt[i]
            if value > score[i + 1] or (value == score[i + 1] and k < tokens[i + 1]):
                score[i + 1], tokens[i + 1], piece[i + 1], before[i + 1] = value, k, -1, i
            table = nested
            for j in range(i, min(n, i + self.pieces.longest)):
                entry = table.get(word[j])
                if entry is None:
                    break
                if entry[0] >= 0:
                    value, k = own + scores[entry[0]], count + 1
                    if value > score[j + 1] or (value == score[j + 1] and k < tokens[j + 1]):
                        score[j + 1], tokens[j + 1], piece[j + 1], before[j + 1] = value, k, entry[0], i
                table = entry[1]
        if uses is not None:
            at, used = n, []
            while at:
                used.append(piece[at])
                at = before[at]
            used = np.array(used)
            uses += weight * np.bincount(used[used >= 0], minlength=len(uses))
        return tokens[n]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word binary, n): every distinct word of the texts and how often it stands in them. Tasks add up what they meet first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: defaultdict[bytes, int] = defaultdict()
        rows.default_factory = rows.__len__
        counts: list[np.ndarray] = []

        def added() -> pa.RecordBatch:
            n = np.bincount(np.concatenate(counts), minlength=len(rows))
            found = pa.RecordBatch.from_arrays([pa.array(list(rows), pa.binary()), pa.array(n, pa.int64())], ["word", "n"])
            rows.clear()
            counts.clear()
            return found

        held = 0
        for batch in batches:
            for part in text_slices(batch):
                flat = [w for t in byte_texts(part) for w in t.split()]
                counts.append(np.fromiter(map(rows.__getitem__, flat), np.int32, len(flat)))
                held += len(flat)
                if held > 16 * MAX_WORDS or len(rows) > MAX_WORDS:
                    yield added()
                    held = 0
        if rows:
            yield added()

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def estimate_scores(docs: DataFrame, path: str = VOCABULARY, rounds: int = ROUNDS, text_col: str = "text") -> np.ndarray:
    """Log probabilities of the vocabulary's pieces, by expectation-maximisation over all words of ``docs``.

    Expectation: each distinct word is segmented best under the scores so far, and its pieces count as often as it stands in the
    texts. Maximisation: a piece's probability is its share of all counts, each plus ``SMOOTHING``. The first scores are those of
    the file's ranks, and they stay where there is no word. The driver gets a number per piece and round.
    """
    scores = rank_scores(path)
    if not rounds:
        return scores
    words = staged(word_counts(docs, text_col), "words")
    for _ in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast(scores)  # 8 bytes a piece

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            found = np.zeros(len(shared.value))
            segment = Segmenter(shared.value, path)
            for batch in batches:
                found += segment.uses([w.decode() for w in batch.column("word").to_pylist()], batch.column("n").to_numpy().astype(np.float64))
            k = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(found[k])], ["piece", "n"])

        rows = words.mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        uses = np.zeros(len(scores))
        uses[[r.piece for r in rows]] = [r.n for r in rows]
        if not uses.any():
            break
        scores = np.log((uses + SMOOTHING) / (uses.sum() + SMOOTHING * len(uses)))
    unstage(words)
    return scores


def token_counts(docs: DataFrame, scores: np.ndarray, path: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens) for each row of ``docs``, under the scores of ``estimate_scores`` or others in the
    vocabulary's order.

    Words are runs of characters other than blanks and line controls, each with a mark before it. A task counts each
    distinct word of its rows once and adds counts up by text. Null and empty texts have none; repeated rows are counted
    each; a null id stays null.
    """
    shared = docs.sparkSession.sparkContext.broadcast(scores)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = Segmenter(shared.value, path)
        rows: defaultdict[bytes, int] = defaultdict()
        rows.default_factory = rows.__len__
        counts = np.empty(0, np.int64)
        for batch in batches:
            for part in text_slices(batch, limit=8 << 20):
                if len(rows) > MAX_WORDS:
                    rows.clear()
                    counts = counts[:0]
                words = [t.split() for t in byte_texts(part)]
                per_text = np.fromiter(map(len, words), np.int64, len(words))
                at = np.fromiter((rows[w] for ws in words for w in ws), np.int64, int(per_text.sum()))
                if len(rows) > len(counts):
                    new = [w.decode() for w in islice(rows, len(counts), None)]
                    counts = np.concatenate([counts, segment.count(new)])
                total = bounds(counts[at])[bounds(per_text)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(per_text), pa.array(np.diff(total))], ["doc_id", "n_words", "n_tokens"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, under piece probabilities of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts(docs, estimate_scores(docs))
