"""Token counts of whole texts with a public tokenizer.

Texts are cut where no token can cross: before a single space between two characters
that are not white space.  The pieces of a batch of texts are looked up in a bounded memo
of the worker, which holds lengths; pieces not in it are cut into words, and each word
not met before goes to the tokenizer's model.  (The library's own batch call takes a third
longer for the same words.)  Texts of any length therefore cost one batch of memory.
"""

from __future__ import annotations

import codecs
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicator_engine.llm.common import slices, text_bytes, worker_wide

BATCH_BYTES = 4 << 20
MEMO_PIECES = 350_000

# How byte-level tokenizers cut a text into words, and the signs for bytes that do not print.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
# up to U+024F, where every character has its kind for good
LATIN_WORDS = ASCII_WORDS.replace("A-Za-z", "A-Za-zªµºÀ-ÖØ-öø-ɏ").replace("0-9", "0-9²³¹¼-¾").replace(r"\t-\r ", "\t-\r \x85\xa0")
_MARKS = tuple(".,;:!?")
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOWN = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_SIGNS = "".join(_SHOWN.get(b, chr(b)) for b in range(256))
# ---- end of fixed values

_LATIN = re.compile("[\0-ɏ]*").fullmatch
_BESIDE = re.compile(r" \s|\s ")
_MARK = "\uffff"  # no character
_SPACES_BESIDE = "[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2}"
# 1: space, 2: line break, 3: a mark, 4: a letter or digit
_BYTE_KINDS = np.array(
    [1 if c == " " else 2 if c == "\n" else 3 if c in _MARKS else 4 * c.isalnum() for c in map(chr, range(128))] + [0] * 128,
    np.uint8,
)
_SAFE = re.compile(r"(?<=\S)(?= \S)")


def pieces(text: str) -> list[str]:
    """Parts of the text that the tokenizer treats alone; together they are the text."""
    if _MARK in text or _BESIDE.search(text):
        return _SAFE.split(text)
    return text.replace(" ", _MARK + " ").split(_MARK)


def by_bytes(texts: list[str | None], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Texts (null: empty) in order, in groups of about ``limit`` characters."""
    group: list[str] = []
    size = 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


class Tokenizer:
    """A tokenizer file of either library: ids of whole texts, and of pieces where texts may be cut."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self.special, self.cut = path, (), False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda text: model.encode(text)
            return
        import json

        import tokenizers

        tokenizer = tokenizers.Tokenizer.from_file(path)
        tokenizer.no_padding()
        tokenizer.no_truncation()
        self.whole = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.model = tokenizer.model
        self.special = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
        with open(path) as file:
            said = json.load(file)
        kind = said.get("pre_tokenizer") or {}
        byte_level = kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space", True)
        self.cut = byte_level and said.get("normalizer") is None
        self.words = regex.compile(BYTE_LEVEL_WORDS).findall
        self.latin_words = re.compile(LATIN_WORDS).findall
        self.ascii_words = re.compile(ASCII_WORDS).findall
        self.known: dict[str, bytes] = {}

    def ids(self, word: str) -> bytes:
        """Ids of a word as unsigned 32-bit integers; words met before are not encoded again."""
        ids = self.known.get(word)
        if ids is None:
            if word.isascii() and word.isprintable():
                shown = word.replace(" ", _SHOWN[32])
            else:
                shown = codecs.charmap_decode(word.encode("utf-8", "surrogatepass"), "strict", _SIGNS)[0]
            ids = self.known[word] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return ids

    def pieces(self, wanted: list[str]) -> list[bytes]:
        """Ids of each piece; letters behind at most one space are one word, and need no look for words.

        So do letters before one mark: the mark is a word of its own.
        """
        if len(self.known) > 2 * MEMO_PIECES:
            self.known.clear()
        of, out = self.ids, []
        for piece in wanted:
            word = piece[1:] if piece[:1] == " " else piece
            if word.isalpha():
                out.append(of(piece))
            elif word[-1:] in _MARKS and word[:-1].isalpha():
                out.append(of(piece[:-1]) + of(piece[-1]))
            elif piece.isascii():
                out.append(b"".join(map(of, self.ascii_words(piece))))
            elif _LATIN(piece):
                out.append(b"".join(map(of, self.latin_words(piece))))
            else:
                out.append(b"".join(map(of, self.words(piece))))
        return out

    def ids_of(self, texts: pa.Array, memo: Memo) -> Iterator[np.ndarray]:
        """Ids of each text (null: empty); ``memo`` holds those of pieces.

        Texts without white space beside white space are cut in one go, and Arrow numbers
        their pieces, so that each distinct one is looked up once.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        whole = pa.array([not self.cut] * len(texts), pa.bool_())
        for special in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, special))
        split = pc.and_not(pc.match_substring_regex(texts, _SPACES_BESIDE), whole)
        plain = texts.filter(pc.invert(pc.or_(whole, split)))
        odd = [_SAFE.split(t) for t in texts.filter(split).to_pylist()]
        data, ends = text_bytes(plain)
        cuts = np.unique(np.concatenate([ends, _word_starts(data)]))
        parts = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)])
        numbered = parts.dictionary_encode()
        found = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = memo.of(set(found).union(*odd))
        each = [known[piece] for piece in found]
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        pool = np.frombuffer(b"".join(each), "<u4")
        at = numbered.indices.to_numpy()
        upto = np.concatenate([[0], np.cumsum(size[at])])
        ids = pool[np.repeat((np.cumsum(size) - size)[at] - upto[:-1], size[at]) + np.arange(upto[-1])]
        done = iter(np.split(ids, upto[np.searchsorted(cuts, ends[1:-1])]))
        others = iter(odd)
        for i, (w, s) in enumerate(zip(whole.to_pylist(), split.to_pylist())):
            if w:
                yield np.array(self.whole(texts[i].as_py()), "<u4")
            elif s:
                yield np.frombuffer(b"".join(map(known.__getitem__, next(others))), "<u4")
            else:
                yield next(done)


def _word_starts(data: np.ndarray) -> np.ndarray:
    """Places in UTF-8 text without white space beside white space where a word begins for sure.

    These are spaces, line breaks and what follows them, and marks behind a letter (up to
    U+024F) or digit.
    """
    kind = _BYTE_KINDS[data]
    starts = (kind == 1) | (kind == 2)
    starts[1:] |= kind[:-1] == 2
    mark = np.flatnonzero(kind == 3)
    mark = mark[mark > 0]
    before, lead = data[mark - 1], data[np.maximum(mark - 2, 0)]
    latin = (before >= 0x80) & (before < 0xC0) & (lead >= 0xC3) & (lead <= 0xC8)
    latin &= (lead != 0xC3) | ((before != 0x97) & (before != 0xB7))  # the signs for times and divided by
    starts[mark] = (kind[mark - 1] == 4) | latin
    return np.flatnonzero(starts)


def text_groups(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[pa.Array]:
    """Texts in order, in groups of about ``limit`` bytes."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        last = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit)) + 1
        yield texts.slice(at, last - at)
        at = last


class Memo:
    """Values of pieces, computed in batches by ``encode``.

    Two generations of ``limit`` pieces are held: when the younger is full, the older
    goes, so that common pieces stay.  The values outlive the task: they depend on the
    piece and on what ``name`` says only.
    """

    def __init__(
        self,
        encode: Callable[[list[str]], list],
        limit: int = MEMO_PIECES,
        name: str | None = None,
        group: str | None = None,
    ):
        self.encode, self.limit = encode, limit
        both = lambda: [{}, {}]
        self.both = both() if name is None else worker_wide(f"memo of {name}", both, group)

    def of(self, wanted: set[str]) -> dict:
        missing = wanted.difference(self.both[0])
        if len(self.both[0]) + len(missing) > self.limit:
            self.both.reverse()
            self.both[0].clear()
            missing = wanted
        known, older = self.both
        new = []
        for piece in missing:
            value = older.get(piece)
            if value is None:
                new.append(piece)
            else:
                known[piece] = value
        for start in range(0, len(new), 50_000):
            part = new[start : start + 50_000]
            known.update(zip(part, self.encode(part)))
        return known


def count_tokens(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = 1024
) -> DataFrame:
    """id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens), a row per row.

    A null text is empty and has 0 tokens; null ids and repeated rows pass through; an
    empty table gives no rows; other columns are not read.  ``path`` is a tokenizer
    file of the ``tokenizers`` (.json) or ``sentencepiece`` (.model) library that every
    executor can read.  Special strings inside a text are treated as the library does.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = f"lengths {path}"
        tokenizer = worker_wide(path, lambda: Tokenizer(path), group)
        memo = Memo(lambda parts: [len(ids) // 4 for ids in tokenizer.pieces(parts)], name=path, group=group)
        for batch in slices(batches):
            sizes: list[int] = []
            counts: list[int] = []
            for group in by_bytes(batch.column("_text").to_pylist()):
                whole = [not tokenizer.cut or any(s in t for s in tokenizer.special) for t in group]
                parts = [[] if w else pieces(t) for t, w in zip(group, whole)]
                known = memo.of(set().union(*parts))
                for text, w, own in zip(group, whole, parts):
                    sizes.append(len(text.encode()))
                    counts.append(len(tokenizer.whole(text)) if w else sum(map(known.__getitem__, own)))
            n = pa.array(counts, pa.int64())
            over = pa.array([c > limit for c in counts], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(sizes, pa.int64()), n, over],
                names=[id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"`{id_column}` long, n_bytes long, n_tokens long, over_limit boolean")
