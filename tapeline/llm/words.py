"""Ids of texts by a tokenizer with word ends, word by word.

The tokenizer drops white space and never looks across it. The texts of a slice are split and their distinct
words found in Arrow; only those are looked up, and only those never met before go to the tokenizer.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a worker remembers from one slice to the next, and the longest one it remembers: a bound of about 200
#: bytes a word on memory, not on results.
REMEMBER = 1_000_000
REMEMBER_CHARS = 48
#: Bytes of a slice of texts.
SLICE = 8_000_000
#: Words given to the tokenizer at once, and a word of one token that stands between them where it may split words.
JOINED, SEPARATOR = 1000, "0"
WORD_END = "</w>"
#: Letters that normalising leaves alone (lower-case Latin-1), and ASCII punctuation: at the end of a word a token run of its own.
LETTERS = "^[a-zß-öø-ÿ]*$"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of `flat` one after the other, and where each ends."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)], ends


class Known:
    """Ids of the texts met, by text: a bounded store whose arrays give the ids of many texts at once."""

    def __init__(self, remember: int = REMEMBER) -> None:
        self.remember = remember
        self._keep({}, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32))

    def _keep(self, place: dict[str, int], start_of: np.ndarray, size_of: np.ndarray, flat: np.ndarray) -> None:
        """The texts known (their place), where their ids start in `flat`, and how many there are."""
        self.place, self.start_of, self.size_of, self.flat = place, start_of, size_of, flat
        self.hits = np.zeros(len(place), np.int64)

    def find(self, texts: list[str]) -> np.ndarray:
        """The place of each text, -1 for one that is not known."""
        return np.fromiter(map(self.place.get, texts, repeat(-1)), np.int64, len(texts))

    def learn(self, texts: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """New texts, with their ids one after the other and how many each has."""
        first = len(self.place)
        self.place.update(zip(texts, range(first, first + len(texts))))
        self.start_of = np.append(self.start_of, len(self.flat) + np.cumsum(sizes) - sizes)
        self.size_of = np.append(self.size_of, sizes)
        self.flat = np.append(self.flat, ids)
        self.hits = np.append(self.hits, np.zeros(len(texts), np.int64))

    def ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts at these places one after the other, and where each ends."""
        return gathered(self.flat, self.start_of[at], self.size_of[at])

    def forget(self, keep: int) -> None:
        """Keep the `keep` texts that were met most often, of those that are not too long."""
        texts = list(self.place)
        order = np.argsort(-self.hits, kind="stable")
        order = order[self.hits[order] > 1][:keep]
        order = np.sort(order[[len(texts[w]) <= REMEMBER_CHARS for w in order]].astype(np.int64))
        ids, ends = self.ids(order)
        sizes = self.size_of[order]
        self._keep({texts[w]: i for i, w in enumerate(order.tolist())}, ends - sizes, sizes, ids)

    def trim(self) -> None:
        """Forget half when there is too much."""
        if len(self.place) > self.remember:
            self.forget(self.remember // 2)


class WordTokenizer:
    """Ids of texts, with a bounded store of the words met.

    The tokenizer's added tokens (marks such as <|endoftext|>) are found in the text as it is written, before it is lowered;
    words that hold one are known by their text after a blank and go to the whole tokenizer one by one.
    """

    def __init__(self, path: str, remember: int = REMEMBER) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.known = Known(remember)
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.marks = [t.content for t in added]
        if any(t.normalized or [t.content] != t.content.split() for t in added):
            raise ValueError("an added token holds white space or is looked for in normalised text")
        if self.tokenizer.model.end_of_word_suffix != WORD_END:
            raise ValueError(f"the tokenizer does not end words by {WORD_END}")
        # a word that only becomes a mark by lowering is none; _marked lifts this for words that hold one
        self.tokenizer.encode_special_tokens = True
        self.between = self._ids(SEPARATOR)
        if len(self.between) != 1:
            raise ValueError(f"{SEPARATOR!r} is not one token")
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        # in letters alone, or punctuation alone, there is nothing to normalise and only blanks to split at
        self.plain = Tokenizer.from_str(self.tokenizer.to_str())
        self.plain.encode_special_tokens = True
        self.plain.normalizer = normalizers.Sequence([])
        bytes_only = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytes_only])

    def _ids(self, text: str, tokenizer=None) -> np.ndarray:
        return np.array((tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _marked(self, word: str) -> np.ndarray:
        self.tokenizer.encode_special_tokens = False
        try:
            return self._ids(word)
        finally:
            self.tokenizer.encode_special_tokens = True

    def forget(self, keep: int) -> None:
        self.known.forget(keep)

    def _by_ends(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for words of one kind of characters: one token of each, its last, ends a word."""
        ids = np.concatenate([np.empty(0, np.uint32), *[self._ids(" ".join(words[at : at + JOINED]), self.plain) for at in range(0, len(words), JOINED)]])
        ends = np.flatnonzero(self.is_end[ids])
        if len(ends) != len(words) or (len(ids) and ends[-1] != len(ids) - 1):
            raise ValueError("a word of plain letters or punctuation does not end where it should")
        return ids, np.diff(ends, prepend=-1)

    def _by_separator(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words without the separator's character, joined by it, whose token none of them can give."""
        line = f" {SEPARATOR} ".join
        ids = np.concatenate([np.empty(0, np.uint32), *[self._ids(line(["", *words[at : at + JOINED]])) for at in range(0, len(words), JOINED)]])
        cuts = np.append(np.flatnonzero(ids == self.between[0]), len(ids))
        return ids[ids != self.between[0]], np.diff(cuts) - 1

    def _learn(self, words: pa.Array) -> None:
        """Distinct words at once. A word of letters and an end of punctuation has the ids of both, often known from other words."""
        stems = pc.utf8_rtrim(words, PUNCTUATION)
        letters = pc.match_substring_regex(stems, LETTERS).to_numpy(zero_copy_only=False)
        whole = pc.equal(stems, words).to_numpy(zero_copy_only=False)
        bare = pc.equal(stems, "").to_numpy(zero_copy_only=False)
        plain = letters & (whole | bare)
        ended = letters & ~plain
        simple = words.filter(pa.array(plain)).to_pylist()
        both = words.filter(pa.array(ended))
        stem = stems.filter(pa.array(ended))
        tail = pa.array([w[n:] for w, n in zip(both.to_pylist(), pc.utf8_length(stem).to_pylist())], pa.string())
        stem, tail = stem.dictionary_encode(), tail.dictionary_encode()
        halves = [stem.dictionary.to_pylist(), tail.dictionary.to_pylist()]
        simple += set(halves[0]).union(halves[1]).difference(self.known.place, simple)
        self.known.learn(simple, *self._by_ends(simple))
        if len(both):
            at = np.stack([self.known.find(half)[coded.indices.to_numpy()] for half, coded in zip(halves, (stem, tail))], axis=1)
            ids, _ = self.known.ids(at.ravel())
            self.known.learn(both.to_pylist(), ids, self.known.size_of[at].sum(axis=1))
        rest, others = [], []
        for word in words.filter(pa.array(~letters)).to_pylist():
            (others if SEPARATOR in word or word[0] == " " else rest).append(word)
        self.known.learn(rest, *self._by_separator(rest))
        if others:
            apart = [self._marked(w[1:]) if w[0] == " " else self._ids(w) for w in others]
            self.known.learn(others, np.concatenate(apart), np.array([len(x) for x in apart]))

    def _words(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, and how many each has. Empty ones are no words."""
        # the tokenizer lowers all letters; of Latin-1 texts this is done here, so that fewer words differ
        plain = [text.lower() if _latin(text) else text for text in texts]
        marked = [i for i, text in enumerate(texts) if any(mark in text for mark in self.marks)]
        for i in marked:
            plain[i] = ""
        split = pc.split_pattern(pc.replace_substring(pa.array(plain, pa.large_string()), "\n", " "), " ")
        words, many = split.flatten(), pc.list_value_length(split).to_numpy().astype(np.int64)
        for i in reversed(marked):
            latin = _latin(texts[i])
            own = [" " + w if any(mark in w for mark in self.marks) else w.lower() if latin else w for w in texts[i].replace("\n", " ").split(" ")]
            at = int(many[:i].sum())
            words = pa.concat_arrays([words.slice(0, at), pa.array(own, pa.large_string()), words.slice(at + int(many[i]))])
            many[i] = len(own)
        return words, many

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if not texts:
            return []
        words, many = self._words(texts)
        coded = words.dictionary_encode()
        distinct, index = coded.dictionary.cast(pa.string()), coded.indices.to_numpy()
        self.known.trim()
        names = distinct.to_pylist()
        at = self.known.find(names)
        empty = np.array([not name for name in names], bool)
        unknown = np.flatnonzero((at < 0) & ~empty)
        if len(unknown):
            self._learn(distinct.take(pa.array(unknown)))
            at[unknown] = self.known.find([names[i] for i in unknown.tolist()])
        self.known.hits[at[~empty]] += np.bincount(index, minlength=len(names))[~empty]
        starts, sizes = np.zeros((2, len(names)), np.int64)
        starts[~empty], sizes[~empty] = self.known.start_of[at[~empty]], self.known.size_of[at[~empty]]
        flat, ends = gathered(self.known.flat, starts[index], sizes[index])
        last = np.append(0, ends)[np.cumsum(many)]
        return np.split(flat, last[:-1])


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE) -> Iterator[tuple[pa.Table, list[str]]]:
    """From Arrow batches: runs of rows with about `most` bytes of text (or one longer text), and their texts (null: empty)."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text).cast(pa.binary())), 0).to_numpy())
        at = 0
        while at < batch.num_rows:
            before = int(sizes[at - 1]) if at else 0
            stop = int(np.searchsorted(sizes, before + most - size, "right"))
            if stop == at and not held:
                stop = at + 1
            if stop > at:
                held.append(batch.slice(at, stop - at))
                size += int(sizes[stop - 1]) - before
                at = stop
            if at < batch.num_rows or size >= most:
                yield _texts(held, text)
                held, size = [], 0
    if held:
        yield _texts(held, text)


def _texts(held: list[pa.RecordBatch], text: str) -> tuple[pa.Table, list[str]]:
    table = pa.Table.from_batches(held)
    return table, [x or "" for x in table.column(text).to_pylist()]
