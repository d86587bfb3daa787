"""BPE encoding of words by walking a trie of their prefixes.

What makes this possible: in BPE a sequence of tokens is the encoding of its text
exactly if each two neighbours stay apart when they are encoded together.  So the
last token of a prefix's encoding is the one vocabulary entry that ends there and
stays apart from the last token of the prefix before it.  A depth-first walk over
the trie of all distinct words computes that token once per shared prefix, and a
word's ids are read off backwards.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from velorank.llm.common import small_batches, whole_text

# Words remembered by a Python worker, and prefix pairs; either is forgotten as a whole when full.
WORDS = 200_000
PAIRS = 500_000
# Bytes of the texts whose distinct words are walked together; longer texts are walked with at most 63 others.
WALK = 1 << 23
# Fixed value: the word pattern that files must have.
_WORD = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# The same for texts without the characters below; other texts are normalised and split by the library.
_PLAIN_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:_|[^\s\w])+")
_RARE = re.compile(r"[^\t-\r -~\xa0-ɏ]|[²³¹¼-¾İ]")
_NEVER = 1 << 60


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte, as byte-level vocabularies use it (a fixed rule)."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(kept)]
    letters = {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


class TrieBpe:
    """Encoder for a byte-level BPE file with an end-of-word suffix and words that white space parts."""

    def __init__(self, file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(file, encoding="utf-8") as source:
            layout = json.load(source)
        model = layout["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"]
        self._library = Tokenizer.from_file(file)
        if layout["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != _WORD:
            raise ValueError("the file splits words by another pattern")
        added = layout["added_tokens"]
        self.names = {i: token for token, i in self.vocab.items()} | {t["id"]: t["content"] for t in added}
        self._special = {t["content"]: t["id"] for t in added}
        self._cut = re.compile("(" + "|".join(map(re.escape, self._special)) + ")") if added else None
        self._letters = str.maketrans(dict(enumerate(_byte_letters())))
        self._bytes = str.maketrans({letter: chr(b) for b, letter in enumerate(_byte_letters())})
        self._rank: dict[tuple[str, str], int] = {}
        self._parts: dict[str, tuple[str, str]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self._rank[left, right] = rank
            if self._parts.setdefault(left + right, (left, right)) != (left, right):
                raise ValueError("a token of two merges has no single history")
        # Lengths of the tokens that end in three given letters, within a word and at its end, longest first;
        # tokens of two letters can end whatever ends in them.
        self._lengths: tuple[dict[str, list[int]], dict[str, list[int]]] = ({}, {})
        for token in self.vocab:
            path = token.removesuffix(self.suffix)
            if len(path) > 2:
                self._lengths[path != token].setdefault(path[-3:], []).append(len(path))
        for table in self._lengths:
            for end, found in table.items():
                table[end] = sorted(set(found), reverse=True)
        self._edges: dict[tuple[str, bool], list[tuple[str, int, int]]] = {}
        self._apart: dict[tuple[str, str], bool] = {}
        self._ids: dict[str, str] = {}
        self._written = {str(i): token for i, token in self.names.items()}

    # Pairs of tokens

    def _edge(self, token: str, right: bool) -> list[tuple[str, int, int]]:
        """What stands at one edge of a token while it is merged: each part, when it arises and when it is used up."""
        found = self._edges.get((token, right))
        if found is None:
            found, part, until = [], token, _NEVER
            while True:
                pair = self._parts.get(part)
                born = self._rank[pair] if pair else -1
                found.append((part, born, until))
                if not pair:
                    break
                part, until = pair[1 if right else 0], born
            self._edges[token, right] = found
        return found

    def stay_apart(self, left: str, right: str) -> bool:
        """Whether no merge ever reaches over the border of the two tokens.

        A merge over the border happens if both parts stand there at its turn.  Of
        equal merges the leftmost comes first, which favours those within the left
        token and puts those within the right one after.
        """
        apart = self._apart.get((left, right))
        if apart is None:
            apart = True
            for a, a_born, a_until in self._edge(left, True):
                for b, b_born, b_until in self._edge(right, False):
                    rank = self._rank.get((a, b))
                    if rank is not None and a_born < rank < a_until and b_born < rank <= b_until:
                        apart = False
            if len(self._apart) >= PAIRS:
                self._apart.clear()
            self._apart[left, right] = apart
        return apart

    # The trie

    def _last(self, path: str, ends: bool, lasts: list[str]) -> str:
        """Last token of the encoding of ``path``; ``lasts`` has that of each shorter prefix."""
        vocab, known, suffix, n = self.vocab, self._apart, self.suffix if ends else "", len(path)
        for length in (*self._lengths[ends].get(path[-3:], ()), 2):
            if length < n:
                token = path[n - length :] + suffix
                if token in vocab:
                    pair = lasts[n - length], token
                    apart = known.get(pair)
                    if self.stay_apart(*pair) if apart is None else apart:
                        return token
            elif length == n and path + suffix in vocab:
                return path + suffix
        token = path[-1] + suffix
        if token not in vocab:
            raise ValueError("a byte is missing in the vocabulary")
        return token

    def encode_words(self, words: Iterable[str]) -> dict[str, list[str]]:
        """Tokens of each distinct word (of byte letters).

        In sorted order the words are the leaves of their trie in depth-first order:
        ``lasts`` is the path from the root, of which a word keeps what it shares
        with the one before.
        """
        out: dict[str, list[str]] = {}
        last, mark = self._last, len(self.suffix)
        lasts, path = [""], ""
        for word in sorted(set(words)):
            n = len(word)
            shared, most = 0, min(len(path), n - 1)
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del lasts[shared + 1 :]
            for k in range(shared + 1, n):
                lasts.append(last(word[:k], False, lasts))
            path = word[:-1]
            token = last(word, True, lasts)
            tokens, n = [token], n - len(token) + mark
            while n:
                token = lasts[n]
                tokens.append(token)
                n -= len(token)
            tokens.reverse()
            out[word] = tokens
        return out

    # Texts

    def words(self, text: str) -> list[str]:
        """The words of a text, normalised."""
        if _RARE.search(text):
            pieces = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
            return [piece.translate(self._bytes).encode("latin-1").decode() for piece, _ in pieces]
        return _PLAIN_WORD.findall(text.lower())

    def _learn(self, words: set[str]) -> None:
        spelt = {w: w.encode().decode("latin-1").translate(self._letters) for w in words}
        encoded, vocab = self.encode_words(spelt.values()), self.vocab
        for word, path in spelt.items():
            self._ids[word] = " ".join([str(vocab[t]) for t in encoded[path]])

    def encode_all(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For each text the number of ids, the ids joined by blanks, and what these ids decode to."""
        split: list[list[str]] = []
        for text in texts:
            if self._cut is None or not any([s in text for s in self._special]):
                split.append(self.words(text))
            else:
                pieces = self._cut.split(text)
                split.append([w for i, p in enumerate(pieces) for w in ([f"\0{p}"] if i % 2 else self.words(p))])
        if len(self._ids) > WORDS:
            self._ids.clear()
        fresh = set().union(*split) - self._ids.keys()
        for special, number in self._special.items():
            if f"\0{special}" in fresh:
                self._ids[f"\0{special}"] = str(number)
        self._learn(fresh - self._ids.keys())
        out = []
        for words in split:
            ids = " ".join(map(self._ids.__getitem__, words))
            numbers = ids.split()
            out.append((len(numbers), ids, self.decode_written(numbers)))
        return out

    def decode_written(self, numbers: Iterable[str]) -> str:
        """Decoding of ids written as decimal numbers."""
        return " ".join(map(self._written.__getitem__, numbers))

    def decode(self, ids: Iterable[int]) -> str:
        """The library's decoding for files that name no decoder: tokens joined by blanks."""
        return " ".join([self.names[i] for i in ids])


@lru_cache(maxsize=2)
def trie_bpe(file: str) -> TrieBpe:
    """Made once in each Python worker."""
    return TrieBpe(file)


def walks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    """First column and texts of consecutive rows: about ``WALK`` bytes of text, at least a row."""
    ids, texts, size = [], [], 0
    for batch in small_batches(batches, 64):
        own = batch.column(1).nbytes
        if texts and size + own > WALK:
            yield pa.concat_arrays(ids), texts
            ids, texts, size = [], [], 0
        ids.append(batch.column(0))
        texts += batch.column(1).to_pylist()
        size += own
    if texts:
        yield pa.concat_arrays(ids), texts


def encode_and_decode(
    docs: DataFrame, file: str, id_column: str = "doc_id", text: str = "text", contents: bool = False
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    With ``contents`` also ``ids`` (array) and ``decoded``.  Null text is empty and
    gives no ids; repeated rows give equal results; an empty table an empty one.
    Nothing is shuffled: a task walks the trie of the new words of some texts at once,
    and remembers a bounded number of words.  Texts are decoded from their ids.
    """
    rows = docs.select(F.col(id_column), whole_text(text).alias("_text"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = trie_bpe(file)
        for own, texts in walks(batches):
            found = encoder.encode_all(texts)
            columns = [own, pa.array([n for n, _, _ in found], pa.int64())]
            columns += [pa.array([hashlib.sha256(x[k].encode()).hexdigest() for x in found], pa.string()) for k in (1, 2)]
            if contents:
                columns.append(pa.array([[int(i) for i in ids.split()] for _, ids, _ in found], pa.list_(pa.int64())))
                columns.append(pa.array([decoded for _, _, decoded in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema[id_column].dataType.simpleString()
    names = [id_column, "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * contents
    schema = f"`{id_column}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(encoded, schema + (", ids array<bigint>, decoded string" if contents else ""))
