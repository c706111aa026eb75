"""N-best segmentation with a SentencePiece vocabulary, and decoding.

A text is normalised as the model's own library does for an identity normaliser: a
space in front, spaces shown as U+2581.  No piece has that sign after another
character, so the lattice of a text is a chain of the lattices of its words, and each
distinct word is solved once per worker (bounded memo), many words side by side:

* forward and backward Viterbi scores give the best path and, over the edges off that
  path, the score of the second best;
* the N best segmentations of a text can only differ from the best one in the N - 1
  words with the smallest gaps; those words' own N best come from an A* search from the
  end of the word, for which the forward scores are the exact rest cost, and the N best
  sums are put together from them.

Scores add up the model's piece scores.  A character without a piece is its UTF-8
bytes, at 10 below the smallest score.

In a BPE model a score is a merge rank; the library merges in that order and maximises
no sum, so its ids are others than those of the best path.  ``encoded`` asks for the
library's own encoding, also word by word: no merge crosses the start of a word.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from indicator_engine.llm.common import slices, worker_wide
from indicator_engine.llm.token_counts import Memo, by_bytes

N_BEST = 4
SIGN = "▁"
MEMO_WORDS = 150_000
UNKNOWN_PENALTY = 10.0
#: characters of words solved side by side
_SLAB = 1 << 14
_NO = -np.inf


class Pieces:
    """The vocabulary as a trie of sorted edges."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.library = model
        self.size = model.vocab_size()
        self.text = [model.id_to_piece(i) for i in range(self.size)]
        self.score = np.array([model.get_score(i) for i in range(self.size)])
        self.byte: dict[int, int] = {}
        plain = []
        for i in range(self.size):
            if model.is_byte(i):
                self.byte[int(self.text[i][3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain.append(i)
        if any(SIGN in self.text[i].lstrip(SIGN) for i in plain):
            raise ValueError("a piece goes on after a word sign; the lattice cannot be cut at words")
        self.of_byte = {i: b for b, i in self.byte.items()}
        self.as_bytes = [
            bytes([self.of_byte[i]]) if i in self.of_byte else self.text[i].encode("utf-8", "surrogatepass")
            for i in range(self.size)
        ]
        self.unknown_id = model.unk_id()
        sign = model.piece_to_id(SIGN)
        self.lone = [sign] if sign != self.unknown_id else self.unknown_ids(ord(SIGN))
        self.unknown = float(self.score[plain].min()) - UNKNOWN_PENALTY if plain else -UNKNOWN_PENALTY
        self.longest = max((len(self.text[i]) for i in plain), default=1)
        edges: dict[int, int] = {}
        ends = [-1]
        for i in plain:
            state = 0
            for c in self.text[i]:
                key = state << 21 | ord(c) + 1
                if key not in edges:
                    edges[key] = len(ends)
                    ends.append(-1)
                state = edges[key]
            ends[state] = i
        self.ends = np.array(ends, np.int64)
        # edges of the trie in a hash table with short probes
        keys, child = np.array(list(edges), np.int64), np.array(list(edges.values()), np.int64)
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.full((1 << self.bits) + 64, -1, np.int64)
        self.child = np.zeros(len(self.keys), np.int64)
        self.probes = 0
        home = self.home(keys)
        left = np.arange(len(keys))
        while len(left):
            slot = home[left] + self.probes
            free = left[self.keys[slot] < 0]
            self.keys[home[free] + self.probes] = keys[free]  # of several the last one stays
            set_ = self.keys[home[left] + self.probes] == keys[left]
            done = left[set_]
            self.child[home[done] + self.probes] = child[done]
            left = left[~set_]
            self.probes += 1

    def home(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def step(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are edges, and the states these lead to."""
        slot = self.home(keys)
        found = self.keys[slot] == keys
        left = np.flatnonzero(~found & (self.keys[slot] >= 0))
        for i in range(1, self.probes):
            there = self.keys[slot[left] + i]
            hit = left[there == keys[left]]
            found[hit] = True
            slot[hit] += i
            left = left[(there >= 0) & (there != keys[left])]
        return found, self.child[slot[found]]

    def unknown_ids(self, char: int) -> list[int]:
        if len(self.byte) < 256:
            return [self.unknown_id]
        return [self.byte[b] for b in chr(char).encode("utf-8", "surrogatepass")]

    # ---- many words at once

    def lattices(self, words: list[str]):
        """Code points plus 1, ``score[L-1, start, word]``, ``piece`` of that shape; minus infinity where no edge is."""
        n = len(words)
        length = np.fromiter(map(len, words), np.int64, n)
        width = int(length.max())
        chars = np.zeros((width + self.longest, n), np.int64)
        row = np.repeat(np.arange(n), length)
        place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        chars[place, row] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4") + np.int64(1)
        flat = chars.ravel()
        at = np.flatnonzero(flat[: width * n])
        state = np.zeros(len(at), np.int64)
        score, piece = np.empty((self.longest, width, n)), np.empty((self.longest, width, n), np.int32)
        sizes = 0
        for size in range(1, self.longest + 1):
            key = state << 21 | flat[at + (size - 1) * n]
            found, state = self.step(key)
            at = at[found]
            if not len(at) and size > 1:
                break
            end = self.ends[state]
            whole = end >= 0
            score[size - 1], piece[size - 1] = _NO, -1
            score[size - 1].ravel()[at[whole]] = self.score[end[whole]]
            piece[size - 1].ravel()[at[whole]] = end[whole]
            sizes = size
        score, piece = score[:sizes], piece[:sizes]
        lost = (chars[:width] > 0) & (piece[0] < 0)
        score[0][lost] = self.unknown
        return chars, score, piece

    def forward(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        longest, width, n = score.shape
        best = np.full((width + 1, n), _NO)
        size = np.zeros((width + 1, n), np.int64)
        best[0] = 0
        for end in range(1, width + 1):
            for length in range(1, min(longest, end) + 1):
                s = best[end - length] + score[length - 1, end - length]
                better = s > best[end]
                np.copyto(best[end], s, where=better)
                np.copyto(size[end], length, where=better)
        return best, size

    def _slabs(self, words: list[str], work) -> list:
        """What ``work`` gives for each word, words of like length going together."""
        out: list = [None] * len(words)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        at = 0
        while at < len(order):
            last = at + 1
            while last < len(order) and (last + 1 - at) * len(words[order[last]]) <= _SLAB:
                last += 1
            for i, solved in zip(order[at:last], work([words[i] for i in order[at:last]])):
                out[i] = solved
            at = last
        return out

    def solve(self, words: list[str]) -> list[tuple[bytes, float, float]]:
        """Ids of the best segmentation, its score, and the gap to the second best (infinite if there is none)."""
        return self._slabs(words, self._solve)

    def _solve(self, words: list[str]) -> list[tuple[bytes, float, float]]:
        chars, score, piece = self.lattices(words)
        longest, width, n = score.shape
        length = np.array([len(w) for w in words])
        rows = np.arange(n)
        best, size = self.forward(score)
        rest = np.full((width + longest + 1, n), _NO)
        rest[length, rows] = 0
        for start in range(width - 1, -1, -1):
            for k in range(1, min(longest, width - start) + 1):
                np.maximum(rest[start], score[k - 1, start] + rest[start + k], out=rest[start])
        total = best[length, rows]
        ids = np.zeros((width, n), np.int64)
        used = np.zeros(n, np.int64)
        off = score.copy()
        end = length.copy()
        while (live := np.flatnonzero(end > 0)).size:
            k = size[end[live], live]
            start = end[live] - k
            got = piece[k - 1, start, live].astype(np.int64)
            ids[used[live], live] = np.where(got < 0, -chars[start, live], got)
            off[k - 1, start, live] = _NO
            used[live] += 1
            end[live] = start
        second = np.full(n, _NO)
        for start in range(width):
            for k in range(1, min(longest, width - start) + 1):
                np.maximum(second, best[start] + off[k - 1, start] + rest[start + k], out=second)
        gap = np.where(second == _NO, np.inf, total - second)
        column = np.arange(width)
        turned = ids[np.maximum(used[:, None] - 1 - column, 0), rows[:, None]].astype("<i4")
        lost = ((turned < 0) & (column < used[:, None])).any(axis=1)
        data = turned.tobytes()
        out = [
            (data[4 * width * row : 4 * (width * row + count)], s, g)
            for row, (count, s, g) in enumerate(zip(used.tolist(), total.tolist(), gap.tolist()))
        ]
        for row in np.flatnonzero(lost).tolist():
            own = turned[row, : used[row]].tolist()
            whole = [x for i in own for x in ([i] if i >= 0 else self.unknown_ids(-1 - i))]
            out[row] = (np.array(whole, "<i4").tobytes(), *out[row][1:])
        return out

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word in the library's own encoding."""
        # the library puts the first sign in front itself, but not before an empty text
        got = self.library.encode([w[1:].replace(SIGN, " ") for w in words])
        got = [self.lone if w == SIGN else ids for w, ids in zip(words, got)]
        data = array("i", chain.from_iterable(got)).tobytes()
        ends = [0, *accumulate(4 * len(ids) for ids in got)]
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def solve_and_encode(self, words: list[str]) -> list[tuple[bytes, float, float, bytes]]:
        return [(*solved, ids) for solved, ids in zip(self.solve(words), self.encode(words))]

    def n_best(self, word: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a word, best first: A* from its end."""
        return self.n_best_of([word], n)[0]

    def n_best_of(self, words: list[str], n: int) -> list[list[tuple[float, list[int]]]]:
        """The same of several words, whose lattices are made side by side."""

        def work(part: list[str]) -> list[list[tuple[float, list[int]]]]:
            chars, score, piece = self.lattices(part)
            best = self.forward(score)[0].T.tolist()
            into: list[list[list]] = [[[] for _ in range(len(w) + 1)] for w in part]
            size, start, column = np.nonzero(score > _NO)
            pieces, scores = piece[size, start, column].tolist(), score[size, start, column].tolist()
            for k, at, j, p, s in zip(size.tolist(), start.tolist(), column.tolist(), pieces, scores):
                into[j][at + k + 1].append((at, p, s))
            return [self._search(len(w), best[j], into[j], chars[:, j], n) for j, w in enumerate(part)]

        return self._slabs(words, work)

    def _search(self, length: int, best: list, into: list, chars: np.ndarray, n: int) -> list[tuple[float, list[int]]]:
        # of equal hopes the one nearer the start goes first, so ties end soon
        agenda = [(-best[length], length, 0, 0.0, None)]
        out: list[tuple[float, list[int]]] = []
        pushed = 0
        while agenda and len(out) < n:
            _, end, _, done, path = heapq.heappop(agenda)
            if end == 0:
                ids: list[int] = []
                while path is not None:
                    start, p, path = path
                    ids += [p] if p >= 0 else self.unknown_ids(int(chars[start]) - 1)
                out.append((done, ids))
                continue
            for start, p, s in into[end]:
                pushed += 1
                heapq.heappush(agenda, (-(best[start] + s + done), start, pushed, s + done, (start, p, path)))
        return out

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.as_bytes.__getitem__, ids.tolist()))
        return data.decode("utf-8", "replace").replace(SIGN, " ").removeprefix(" ")


def words_of(text: str) -> list[str]:
    """Parts of the normalised text, each a run of word signs and what follows; the signs are put in."""
    if not text:
        return []
    if "  " not in text and SIGN not in text and text[0] != " " and text[-1] != " ":
        return (SIGN + text.replace(" ", " " + SIGN)).split(" ")
    first, *rest = text.replace(SIGN, " ").split(" ")
    out: list[str] = []
    signs = SIGN
    for word in (first, *rest):
        if word:
            out.append(signs + word)
            signs = SIGN
        else:
            signs += SIGN
    if len(signs) > 1:
        out.append(signs[:-1])
    return out


def _best_sums(lists: list[list[tuple[float, list[int]]]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n largest sums of one entry from each list, with the entries chosen."""
    sums: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
    for entries in lists:
        every = ((s + e[0], (*chosen, i)) for s, chosen in sums for i, e in enumerate(entries))
        sums = heapq.nsmallest(n, every, key=lambda x: (-x[0], x[1]))
    return sums


def segment(
    docs: DataFrame,
    path: str,
    n_best: int = N_BEST,
    text_column: str = "text",
    alternatives: bool = False,
    encoded: bool = False,
    decoded: bool = False,
    memo_words: int = MEMO_WORDS,
) -> DataFrame:
    """The rows of ``docs`` with ``piece_ids`` (best segmentation) and ``piece_scores`` (of the n best, best first).

    With ``alternatives`` also ``piece_alternatives``, the ids of all n; with ``encoded``
    also ``encoded_ids``, what the model's library encodes the text to, and with ``decoded``
    the text of these (else of the best) ids, as ``decode`` gives it.  Null and empty
    texts have no pieces and one segmentation, of score 0.  Null ids, repeated rows and
    empty tables pass through; columns of the new names are replaced.  A worker holds
    at most twice ``memo_words`` words, about 0.4 KB each.
    """
    new = {"piece_ids": T.ArrayType(T.IntegerType()), "piece_scores": T.ArrayType(T.DoubleType())}
    if alternatives:
        new["piece_alternatives"] = T.ArrayType(T.ArrayType(T.IntegerType()))
    if encoded:
        new["encoded_ids"] = T.ArrayType(T.IntegerType())
    if decoded:
        new["decoded"] = T.StringType()
    keep = [c for c in docs.columns if c not in new]
    at = keep.index(text_column)
    schema = docs.select(*keep).schema
    for name, kind in new.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = f"pieces {path}"
        model = worker_wide(group, lambda: Pieces(path), group)
        # one look-up a word: its encoding is worked out and held with its best segmentation
        memo = Memo(model.solve_and_encode if encoded else model.solve, memo_words, f"best {encoded}", group)
        several = Memo(lambda words: model.n_best_of(words, n_best), max(1, memo_words // 20), f"{n_best} best", group)
        for batch in slices(batches, 250):
            ids: list[bytes] = []
            library: list[bytes] = []
            scores: list[list[float]] = []
            others: list[bytes] = []
            counts: list[int] = []
            for group in by_bytes(batch.column(at).cast(pa.string()).to_pylist()):
                parts = [words_of(t) for t in group]
                known = memo.of(set().union(*parts))
                solved = []
                for own in parts:
                    data, each, gaps, *cut = zip(*map(known.__getitem__, own)) if own else ((), (), (), ())
                    ids.append(b"".join(data))
                    if encoded:
                        library.append(b"".join(cut[0]))
                    loose = _smallest(np.fromiter(gaps, np.float64, len(gaps)), n_best - 1)
                    fixed = sum(each) - sum(each[i] for i in loose)
                    solved.append((data, [own[i] for i in loose], loose, fixed))
                picked = several.of({word for _, words, _, _ in solved for word in words})
                for data, words, loose, fixed in solved:
                    choices = [picked[word] for word in words]
                    sums = _best_sums(choices, n_best)
                    scores.append([fixed + s for s, _ in sums])
                    if alternatives:
                        others += [_replaced(data, loose, [c[i][1] for c, i in zip(choices, chosen)]) for _, chosen in sums]
                        counts.append(len(sums))
            columns = [_id_lists(ids), pa.array(scores, pa.list_(pa.float64()))]
            if alternatives:
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), _id_lists(others)))
            if encoded:
                columns.append(_id_lists(library))
            if decoded:
                flat = [np.frombuffer(i, "<i4") for i in (library if encoded else ids)]
                columns.append(pa.array([model.decode(i) for i in flat], pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*keep, *new])

    return docs.select(*keep).mapInArrow(run, schema)


def _id_lists(ids: list[bytes]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))


def _smallest(gaps: np.ndarray, n: int) -> list[int]:
    """Places of the n smallest finite gaps, of equal ones the first, in order of place."""
    if not len(gaps) or n < 1:
        return []
    if len(gaps) > n:
        edge = np.partition(gaps, n - 1)[n - 1]
        below, tied = np.flatnonzero(gaps < edge), np.flatnonzero(gaps == edge)
        at = np.sort(np.concatenate([below, tied[: n - len(below)]]))
    else:
        at = np.arange(len(gaps))
    return at[gaps[at] < np.inf].tolist()


def _replaced(data: tuple[bytes, ...], at: list[int], ids: list[list[int]]) -> bytes:
    out = list(data)
    for i, other in zip(at, ids):
        out[i] = np.array(other, "<i4").tobytes()
    return b"".join(out)


def decode(pieces: DataFrame, path: str, ids_column: str = "piece_ids") -> DataFrame:
    """The rows of ``pieces`` with ``decoded``, the text of their ids; null ids give a null text."""
    keep = [c for c in pieces.columns if c != "decoded"]
    at = keep.index(ids_column)
    schema = pieces.select(*keep).schema.add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_wide(f"pieces {path}", lambda: Pieces(path))
        for batch in slices(batches):
            column = batch.column(at)
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            known = column.is_valid().to_pylist()
            texts = [
                model.decode(flat[a:b]) if ok else None for a, b, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), known)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return pieces.select(*keep).mapInArrow(run, schema)
