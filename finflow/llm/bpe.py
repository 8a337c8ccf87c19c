"""Byte-pair encoding and decoding by a segment tree over the ranks of neighbouring pairs.

A word starts as one symbol per byte. Every pair of neighbours that the merge table
knows has a rank; a segment tree over the pairs keeps the least of ``rank, place``, so
its root names the leftmost pair of the lowest rank. Merging a pair changes three
leaves: the pair itself, its left neighbour and the pair that is gone, each in
logarithmic time; the word is done when the root holds no pair. A word of n bytes
costs n log n, however long it is. The trees of many short words stand in the rows of one
array and make their merges at the same time. Tasks remember the ids of words they have
met, up to a bound, so a frequent word is merged once.

What comes before the merges is what the file says: special tokens cut out of the raw
text, normalization, the split into words, bytes as characters. Texts of characters
on whose treatment all Unicode versions agree (Latin letters, general punctuation)
go through one pattern; all others go through the normalizer and splitter of the
``tokenizers`` library, so that both agree with it to the byte.

Edge cases: a null or empty text has no ids and decodes to the empty text. Rows are
kept as they come, null and repeated ids included. A text is worked on in pieces of
about a million characters, cut at white space. Decoding drops nulls and ids that the
vocabulary lacks. Further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from finflow.llm import words as w

# Fixed value: the split of the supported files, as they spell it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Characters outside these are left to the library: their case, class or composition
# depends on the version of Unicode.
_UNSTABLE = re.compile("[^\u0000-\u024f\u2010-\u2027]")
_CUT = re.compile("[ \n]")

PIECE = 1 << 20  # characters worked on at a time
MOST_CACHED = 250_000  # words remembered by a task, in each of two caches
LONGEST_CACHED = 64  # bytes of such a word, and of words merged together

_NO_PAIR = 1 << 62


class Merges:
    """The merge table: the rank of each pair of symbols, and the symbol each rank makes."""

    def __init__(self, pairs: list[tuple[int, int, int]], width: int):
        self.width = width  # symbols are below it
        self.made = [made for _, _, made in pairs]
        # A pair listed twice has its last rank, as in the library.
        self.ranks = {left * width + right: rank for rank, (left, right, _) in enumerate(pairs)}
        # The same as arrays, in order of pairs; the end is a pair that no two symbols make.
        order = sorted(self.ranks)
        self.keys = np.array([*order, np.iinfo(np.int64).max], np.int64)
        self.rank_of_key = np.array([*map(self.ranks.__getitem__, order), 0], np.int64)
        self.made_by_rank = np.array([*self.made, 0], np.int64)

    def values(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
        """``rank * n + place`` of pairs of symbols; pairs with a symbol below 0 are none."""
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        known = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.rank_of_key[at] * n + place, _NO_PAIR)


def merge(symbols: list[int], merges: Merges) -> list[int]:
    """Merge the leftmost pair of lowest rank until none is left.

    Leaf ``size + i`` of the tree is the pair that begins at symbol ``i``, as
    ``rank * n + i``; a node is the lesser of its two children, so node 1 is the
    next merge. ``after`` and ``before`` link the symbols that are left.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    rank_of, made, width = merges.ranks.get, merges.made, merges.width
    size = 1 << (n - 2).bit_length()
    tree = [_NO_PAIR] * (2 * size)
    for i in range(n - 1):
        rank = rank_of(symbols[i] * width + symbols[i + 1])
        if rank is not None:
            tree[size + i] = rank * n + i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b

    symbols = symbols[:]
    after, before = list(range(1, n + 1)), list(range(-1, n))
    while (least := tree[1]) < _NO_PAIR:
        rank, left = divmod(least, n)
        gone = after[left]
        right, previous = after[gone], before[left]
        symbols[left], symbols[gone] = made[rank], -1
        after[left], before[right] = right, left
        changes = [(left, right), (gone, n)]
        if previous >= 0:
            changes.append((previous, left))
        for place, other in changes:
            rank = rank_of(symbols[place] * width + symbols[other]) if other < n else None
            value = _NO_PAIR if rank is None else rank * n + place
            i = size + place
            if i >= 2 * size:  # the last symbol begins no pair
                continue
            tree[i] = value
            while i > 1:  # up to the root, or as far as the least changes
                b = tree[i ^ 1]
                if b < value:
                    value = b
                i >>= 1
                if tree[i] == value:
                    break
                tree[i] = value
    return [s for s in symbols if s >= 0]


def merge_many(symbols: np.ndarray, merges: Merges) -> np.ndarray:
    """``merge`` of every row of a matrix; -1 fills up rows and stands in the place of symbols that are gone.

    The rows' trees are rows of one array; each round makes the next merge of every row
    that has one.
    """
    words, n = symbols.shape
    size = 1 << (n - 1).bit_length()
    symbols = np.hstack((symbols, np.full((words, 1), -1)))  # a last one that pairs with nothing
    places = np.arange(n)
    tree = np.full((words, 2 * size), _NO_PAIR)
    tree[:, size : size + n] = merges.values(symbols[:, :-1], symbols[:, 1:], places, n)
    for level in range(size.bit_length() - 2, -1, -1):
        first = 1 << level
        below = tree[:, 2 * first : 4 * first]
        tree[:, first : 2 * first] = np.minimum(below[:, ::2], below[:, 1::2])
    # Flat views: an element is named by its row's base and its place.
    after = np.tile(np.arange(1, n + 2), (words, 1)).ravel()
    before = np.tile(np.arange(-1, n), (words, 1)).ravel()
    flat, nodes = symbols.ravel(), tree.ravel()
    row = np.arange(words)
    while True:
        least = nodes[row * (2 * size) + 1]
        going = least < _NO_PAIR
        row, least = row[going], least[going]
        if not len(row):
            return flat.reshape(words, n + 1)[:, :n]
        base, root = row * (n + 1), row * (2 * size)
        rank, left = np.divmod(least, n)
        gone = after[base + left]
        right, previous = after[base + gone], before[base + left]
        flat[base + left], flat[base + gone] = merges.made_by_rank[rank], -1
        after[base + left], before[base + right] = right, left
        nodes[root + size + gone] = _NO_PAIR
        nodes[root + size + left] = merges.values(flat[base + left], flat[base + right], left, n)
        some = previous >= 0
        to_left = merges.values(flat[base + previous * some], flat[base + left], previous, n)
        nodes[(root + size + previous)[some]] = to_left[some]
        for place in (gone, left, np.where(some, previous, left)):
            node = size + place
            for _ in range(size.bit_length() - 1):
                node >>= 1
                pair = root + 2 * node
                nodes[root + node] = np.minimum(nodes[pair], nodes[pair + 1])


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Bpe:
    """A tokenizer file of the supported kind; ``ValueError`` names what else a file asks for."""

    def __init__(self, source: str):
        self.source = source
        said = json.loads(source)
        model = said["model"]
        wanted = {
            "model": model["type"] == "BPE",
            "normalizer": [n["type"] for n in (said["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"],
            "pre_tokenizer": [p["type"] for p in (said["pre_tokenizer"] or {}).get("pretokenizers", [])] == ["Split", "ByteLevel"]
            and said["pre_tokenizer"]["pretokenizers"][0]["pattern"] == {"Regex": SPLIT},
            "decoder": said["decoder"] is None,
            "added_tokens": not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in said["added_tokens"]),
        } | {
            name: not model.get(name)
            for name in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
        }
        if not all(wanted.values()):
            raise ValueError(f"not supported: {', '.join(k for k, v in wanted.items() if not v)}")

        vocabulary = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        characters = byte_characters()
        self.inner = np.array([vocabulary.get(c, -1) for c in characters], np.int64)
        self.last = np.array([vocabulary.get(c + self.end, -1) for c in characters], np.int64)
        self.byte_of = {c: b for b, c in enumerate(characters)}
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        self.merges = Merges([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs], max(vocabulary.values()) + 1)
        self.special = {t["content"]: np.int32(t["id"]).tobytes() for t in said["added_tokens"]}
        self._cut_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        import regex

        # White space is spelled out: libraries differ on U+001C to U+001F. Unstable characters never get here.
        self._words = regex.compile(SPLIT.replace(r"\s", r"\t-\r \x85\xa0"))
        self._library = None
        self._seen: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        ids = max([*vocabulary.values(), *(t["id"] for t in said["added_tokens"])]) + 1
        tokens = [None] * ids
        for token, i in [*vocabulary.items(), *((t["content"], t["id"]) for t in said["added_tokens"])]:
            tokens[i] = token
        self.tokens = pa.array(tokens, pa.string())

    def encode_word(self, word: bytes) -> bytes:
        data = np.frombuffer(word, np.uint8)
        symbols = np.append(self.inner[data[:-1]], self.last[data[-1:]])
        return np.array(merge(symbols[symbols >= 0].tolist(), self.merges), np.int32).tobytes()

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word; words of about the same length are merged together."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        whole = min(self.inner.min(), self.last.min()) >= 0  # every byte has its symbols
        done = 0
        for width in (4, 8, 16, 32, LONGEST_CACHED):
            at = np.flatnonzero((sizes > done) & (sizes <= width)) if whole else np.zeros(0, int)
            done = width if whole else 0
            if not len(at):
                continue
            data = np.frombuffer(b"".join(words[i] for i in at), np.uint8)
            ends = np.cumsum(sizes[at])
            symbols = self.inner[data]
            symbols[ends - 1] = self.last[data[ends - 1]]
            place = np.arange(len(data)) - np.repeat(ends - sizes[at], sizes[at])
            table = np.full((len(at), width), -1)
            table[np.repeat(np.arange(len(at)), sizes[at]), place] = symbols
            merged = merge_many(table, self.merges)
            kept = merged >= 0
            ids = merged[kept].astype(np.int32).tobytes()
            bounds = [0, *(4 * np.cumsum(kept.sum(axis=1))).tolist()]
            for i, a, b in zip(at.tolist(), bounds, bounds[1:]):
                out[i] = ids[a:b]
        for i in np.flatnonzero(sizes > done).tolist():
            out[i] = self.encode_word(words[i])
        return out

    def _split(self, text: str) -> list[str]:
        """Words of a piece without special tokens."""
        if _UNSTABLE.search(text) is None:
            return self._words.findall(text.lower())
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.source)
        pieces = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, p)).decode() for p, _ in pieces]

    def _pieces(self, text: str) -> Iterator[list[str] | bytes]:
        """The words of each piece of a text, and the ids of the special tokens between them."""
        begin = 0
        while begin < len(text):
            cut = _CUT.search(text, begin + PIECE)
            end = cut.start() if cut else len(text)
            piece, done = text[begin:end], 0
            for special in self._cut_special.finditer(piece):
                yield self._split(piece[done : special.start()])
                yield self.special[special[0]]
                done = special.end()
            yield self._split(piece[done:])
            begin = end

    def _learn(self, lists: list[list[str]]) -> None:
        """Make sure that the ids of all these words are known."""
        if len(self._seen) > MOST_CACHED:  # words not met since the last change of cache go
            self._older, self._seen = self._seen, {}
        new = set().union(*lists).difference(self._seen)
        again = new.intersection(self._older)
        self._seen.update((word, self._older[word]) for word in again)
        new = [word for word in new if word not in again]
        self._long = [word for word in new if len(word) > LONGEST_CACHED]
        self._seen.update(zip(new, self.encode_words([word.encode() for word in new])))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as 32-bit numbers."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str] | bytes]] = []

        def settle() -> None:
            self._learn([found for _, found in waiting if isinstance(found, list)])
            get = self._seen.__getitem__
            for i, found in waiting:
                out[i].append(found if isinstance(found, bytes) else b"".join(map(get, found)))
            for word in self._long:
                del self._seen[word]
            waiting.clear()

        size = 0
        for i, text in enumerate(texts):
            for found in self._pieces(text):
                waiting.append((i, found))
                size += len(found)
                if size > PIECE // 4:  # words
                    settle()
                    size = 0
        settle()
        return [b"".join(parts) for parts in out]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Texts of lists of ids: the tokens joined by a space."""
        offsets = ids.offsets.to_numpy().astype(np.int64)
        values = ids.values.slice(offsets[0], offsets[-1] - offsets[0])
        known = np.asarray(pc.fill_null(values, -1)).astype(np.int64)
        known = np.where((known >= 0) & (known < len(self.tokens)), known, -1)
        tokens = pc.take(self.tokens, pa.array(known, mask=known < 0))
        valid = np.asarray(tokens.is_valid())
        kept = np.concatenate(([0], np.cumsum(valid)))[offsets - offsets[0]]
        lists = pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), tokens.filter(pa.array(valid)))
        return pc.binary_join(lists, " ")


_LOADED: dict[str, Bpe] = {}


def loaded(source: str) -> Bpe:
    """The tokenizer of a file's content, built once by worker."""
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Bpe(source)
    return _LOADED[key]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every text, by the tokenizer file at ``path`` on the driver."""
    with open(path, encoding="utf-8") as file:
        source = file.read()
    Bpe(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(source)
        for batch in batches:
            data, offsets = w.text_column(batch, "text")
            names = batch.column(0)
            for first, last in w.runs(offsets):
                found = bpe.encode([data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in range(first, last)])
                sizes = np.array([len(f) // 4 for f in found], np.int64)
                bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(found), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(bounds), values)
                yield pa.RecordBatch.from_arrays(
                    [names.slice(first, last - first), pa.array(sizes), lists], ["doc_id", "n_tokens", "ids"]
                )

    own = docs.select("doc_id", "text")
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (``doc_id, n_tokens, ids``) and the column ``decoded``."""
    with open(path, encoding="utf-8") as file:
        source = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(source)
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy().astype(np.int64) * 4
            for first, last in w.runs(offsets):
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, bpe.decode(part.column(2))], ["doc_id", "n_tokens", "ids", "decoded"]
                )

    own = encoded.select("doc_id", "n_tokens", "ids")
    name = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"doc_id {name}, n_tokens long, ids array<int>, decoded string")
