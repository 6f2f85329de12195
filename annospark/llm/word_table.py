"""Distinct-word tables: each distinct word that a worker meets is encoded once, ids come back by position."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

from annospark.llm.common import bounds, gather, text_slices

#: The characters of Unicode's White_Space property; letters and digits of the first 256 characters; marks that
#: belong to no word nor special token.
WHITE_SPACE = r"\t-\r " + "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
LETTERS, DIGITS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe"
MARKS = ",.;:!?%$&*#"
#: A word is a run of white space with the run of other characters that follows, cut before marks behind a letter or digit.
#: The byte vocabulary's pre-tokenizer ends a piece at these places, and looks no further back, so words are encoded alone.
WORD = re.compile(
    f"[{WHITE_SPACE}]*(?:[^{WHITE_SPACE}{MARKS}]+(?:(?<![{LETTERS}{DIGITS}])[{MARKS}]+[^{WHITE_SPACE}{MARKS}]*)*|[{MARKS}]+[^{WHITE_SPACE}]*)|[{WHITE_SPACE}]+"
)
#: Pieces of the word vocabulary's pre-tokenizer, for lower-case text of the first 256 characters.
PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{WHITE_SPACE}{LETTERS}{DIGITS}]+")
#: Words of other text; the word vocabulary drops white space.
BARE_WORD = re.compile(f"[^{WHITE_SPACE}]+")
#: Latin text, on whose character classes all versions of Unicode agree.
LATIN = re.compile(f"[{chr(0)}-{chr(0x24F)}]*")
#: Words that a table holds before it starts anew; bounds a worker's memory, changes no result.
MAX_WORDS = 500_000
#: Longest word whose pieces tiktoken's pattern is asked for; it gives up on runs of some hundred thousand blanks.
MAX_FAST = 1 << 14
#: Words encoded in one call.
CALL_WORDS = 1024


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, without truncation or padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=1)
def byte_of() -> dict[str, int]:
    """The byte that a character of a piece stands for: a printable byte for itself, the n-th of the others as 256 + n."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def _together(words: list[str], ids: Callable[[str], list[int]], mark: str, mark_id: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Flat ids and lengths of words joined by a special token, at which the encoder cuts a text before anything else."""
    parts, lengths = [], []
    for k in range(0, len(words), CALL_WORDS):
        call = words[k : k + CALL_WORDS]
        flat = np.array(ids(mark.join(call)), np.int32)
        cuts = np.flatnonzero(flat == mark_id)
        parts.append(np.delete(flat, cuts))
        lengths.append(np.diff(np.concatenate([[-1], cuts, [len(flat)]])) - 1)
    return parts, lengths


class Vocabulary:
    """A vocabulary file, and how texts are split into words that it encodes alone."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer(path)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.mark, self.mark_id = min(self.special.items(), key=lambda s: s[1])

    def split(self, text: str) -> list[str]:
        raise NotImplementedError

    def encode(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The words in the order in which they were encoded, their ids one after another, and each one's length."""
        raise NotImplementedError

    def library(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        return _together(words, lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids, self.mark, self.mark_id)

    def alone(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        parts = [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.int32) for w in words]
        return parts, [np.fromiter(map(len, parts), np.int64, len(parts))]


class ByteVocabulary(Vocabulary):
    """Byte-level BPE. Latin words go through tiktoken, which has the same merges as ranks and is some times as fast. Very long
    words go through the library, each alone."""

    @cached_property
    def fast(self) -> tiktoken.Encoding:
        ranks = {bytes(map(byte_of().__getitem__, piece)): i for piece, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        return tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=self.special)

    def split(self, text: str) -> list[str]:
        return WORD.findall(text)

    def encode(self, words):
        odd = [w for w in words if len(w) > MAX_FAST or self.mark in w]
        rest = [w for w in words if len(w) <= MAX_FAST and self.mark not in w] if odd else words
        latin = [w for w in rest if LATIN.fullmatch(w)]
        other = [w for w in rest if not LATIN.fullmatch(w)] if len(latin) < len(rest) else []
        a, n = _together(latin, lambda text: self.fast.encode(text, allowed_special="all"), self.mark, self.mark_id)
        for more in (self.library(other), self.alone(odd)):
            a, n = a + more[0], n + more[1]
        return latin + other + odd, np.concatenate([np.empty(0, np.int32), *a]), np.concatenate([np.empty(0, np.int64), *n]).astype(np.int64)


class WordVocabulary(Vocabulary):
    """BPE with word ends, lower case, white space dropped.

    For text of the first 256 characters without special tokens, normalisation is ``lower`` alone and pieces are found here;
    tiktoken encodes a piece by the same merges, a byte that no UTF-8 text has standing for the word's end. Any other text is
    split at white space and left to the library; a line end marks such words.
    """

    END = b"\xff"

    @cached_property
    def fast(self) -> tiktoken.Encoding:
        ranks = {}
        for piece, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            ends = piece.endswith("</w>")
            ranks[bytes(map(byte_of().__getitem__, piece.removesuffix("</w>"))) + self.END * ends] = i
        ranks[self.END] = max(ranks.values()) + 1  # never left alone: the last byte and the end merge first
        return tiktoken.Encoding("pieces", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def split(self, text: str) -> list[str]:
        if "<|" not in text:
            try:
                text.encode("latin-1")
                return PIECE.findall(text.lower())
            except UnicodeEncodeError:
                pass
        return ["\n" + w for w in BARE_WORD.findall(text)]

    def encode(self, words):
        pieces = [w for w in words if w[0] != "\n"]
        rest = [w for w in words if w[0] == "\n"] if len(pieces) < len(words) else []
        odd = [w for w in rest if self.mark in w]
        other = [w for w in rest if self.mark not in w]
        one = self.fast._core_bpe.encode_single_piece
        found = [one(w.encode() + self.END) for w in pieces]
        a, n = [np.fromiter((i for ids in found for i in ids), np.int32)], [np.fromiter(map(len, found), np.int64, len(found))]
        for more in (self.library([w[1:] for w in other]), self.alone([w[1:] for w in odd])):
            a, n = a + more[0], n + more[1]
        return pieces + other + odd, np.concatenate(a), np.concatenate(n).astype(np.int64)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, by whether its pieces mark word ends."""
    return (WordVocabulary if tokenizer(path).model.end_of_word_suffix else ByteVocabulary)(path)


class _Rows(dict):
    """word -> row; a new word gets the next row and waits for its ids."""

    def __init__(self):
        self.waiting: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self)
        self.waiting.append(word)
        return row


class WordTable:
    """Rows of distinct words, and the ids of each row."""

    def __init__(self, words: Vocabulary):
        self.vocabulary = words
        self.clear()

    def clear(self) -> None:
        self.rows = _Rows()
        self.ids, self.starts, self.lengths = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _add(self) -> bool:
        """Encode the waiting words; whether rows had to follow another order of encoding."""
        waiting, self.rows.waiting = self.rows.waiting, []
        try:
            words, ids, lengths = self.vocabulary.encode(waiting)
        except BaseException:
            self.clear()  # no row without ids stays
            raise
        moved = words != waiting
        if moved:
            self.rows.update(zip(words, range(len(self.lengths), len(self.rows))))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths, self.ids = np.concatenate([self.lengths, lengths]), np.concatenate([self.ids, ids])
        return moved

    def look_up(self, words: list[str]) -> np.ndarray:
        """The row of each word; words not seen before are encoded."""
        if len(self.rows) > MAX_WORDS:
            self.clear()
        at = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        if self.rows.waiting and self._add():
            at = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
        return at

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has."""
        at = self.look_up(words)
        return gather(self.ids, self.starts[at], self.lengths[at]), self.lengths[at]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        words = [self.vocabulary.split(t) for t in texts]
        per_text = np.fromiter(map(len, words), np.int64, len(words))
        ids, lengths = self.encode_words([w for ws in words for w in ws])
        return ids, np.diff(bounds(lengths)[bounds(per_text)])


@lru_cache(maxsize=2)
def _table(path: str) -> WordTable:
    return WordTable(vocabulary(path))


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the rows, with the ids of their ``text`` and how many each has; null text counts as empty. A worker keeps
    its table from task to task."""
    table = _table(path)
    for batch in batches:
        for rows in text_slices(batch):
            yield rows, *table.encode([t or "" for t in rows.column("text").to_pylist()])
