"""Encoding with merge-type piece vocabularies, by a score-ordered agenda of adjacent symbol pairs.

The vocabulary file is read with the sentencepiece library; segmenting is done here
and held against the library in every Arrow batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallybrook.llm.memory import RunMemory, grouped, joined_units, per_text, small_slices

#: The library's mark for a blank.
BLANK = "▁"
#: Runs up to this length are segmented many at a time; so many share an agenda's steps.
SHORT = 24
TOGETHER = 2_000


class PieceEncoder:
    """Encoder for one vocabulary of the merge type with byte fallback.

    A blank becomes a mark and one more goes before the text, as the vocabulary's
    normaliser (identity, dummy prefix) has it. No piece of the vocabulary has a
    mark after another character, so no merge crosses the border before a mark: runs
    between such borders are encoded one by one, and frequent runs are remembered.
    Vocabularies for which this doesn't hold are refused. With ``check``, every run
    that isn't remembered yet is encoded by the library as well, and an id that
    differs is an error.
    """

    def __init__(self, path: str, check: bool = True):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.begin, self.end = library.bos_id(), library.eos_id()
        self.head, self.tail = (np.array([i], dtype="<u4").tobytes() for i in (self.begin, self.end))
        size = library.get_piece_size()
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) for i in range(size)]
        self.ids = {library.id_to_piece(i): i for i in range(size) if not special[i]}
        self.order = {p: -library.get_score(i) for p, i in self.ids.items()}
        self.bytes = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("a piece has a blank after another character")
        if not all(library.is_byte(i) for i in self.bytes):
            raise ValueError("the vocabulary has no byte fallback")
        if library.normalize(" a   ﬁ ") != f"{BLANK}{BLANK}a{BLANK} {BLANK}ﬁ{BLANK}":
            raise ValueError("the vocabulary's normaliser changes texts")
        self.check = check
        self.memory = RunMemory(self._new_runs)
        self._pair_tables()

    def _pair_tables(self) -> None:
        """Symbols as numbers, and for pairs of symbols what they make and how good that is."""
        number = dict(self.ids)
        characters = {c for p in self.ids for c in p}
        # Characters of no piece are borders as well; of these, line ends and tabs are frequent.
        self._apart = np.zeros(1 << 16, dtype=bool)
        self._apart[[ord(c) for c in "\n\r\t" if c not in characters]] = True
        for c in characters - number.keys():
            number[c] = len(self.bytes) + self.library.get_piece_size() + len(number)
        best = sorted({*self.order.values()})
        rank = {score: i for i, score in enumerate(best)}
        pairs = [
            (number[p[:k]] << 20 | number[p[k:]], i, rank[self.order[p]])
            for p, i in self.ids.items()
            for k in range(1, len(p))
            if p[:k] in number and p[k:] in number
        ]
        pairs.sort()
        self._keys, self._made, self._ranks = (np.array(x, dtype=np.int64) for x in zip(*pairs))
        self._ranks, self._made = self._ranks.astype(np.int32), self._made.astype(np.int32)
        self._symbol = np.full(0x110000, -1, dtype=np.int32)
        for c, i in number.items():
            # A character that is no piece itself needs its bytes: left to segment().
            if len(c) == 1 and c in self.ids:
                self._symbol[ord(c)] = i

    def encode(self, text: str) -> list[int]:
        """Ids of a text, without those for begin and end."""
        return self.encode_batch([text])[0].tolist()

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for _, group in grouped(texts):
            # A mark in the text itself counts as a blank; an empty text has no dummy prefix either.
            units, bounds = joined_units([" " + t.replace(BLANK, " ") if t else "" for t in group])
            blank, apart = units == 0x20, self._apart[units]
            border = np.ones(len(units), dtype=bool)
            border[1:] = (blank[1:] & ~blank[:-1]) | (apart[1:] != apart[:-1])
            border[bounds[:-1][bounds[:-1] < len(units)]] = True
            start = np.flatnonzero(border)
            ids, counts = self.memory.encode(units, start, np.append(start[1:], len(units)))
            cuts = per_text(counts, start, bounds)
            out += [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        return out

    def _new_runs(self, runs: list[str]) -> list[list[int]]:
        marked = [r.replace(" ", BLANK) for r in runs]
        found: dict[str, list[int]] = {}
        short = sorted({r for r in marked if len(r) <= SHORT}, key=len)
        for first in range(0, len(short), TOGETHER):
            found |= self.segment_short(short[first : first + TOGETHER])
        for r in marked:
            if r not in found:
                found[r] = self.segment(r)
        ids = [found[r] for r in marked]
        if self.check:
            self._compare(runs, ids)
        return ids

    def _compare(self, runs: list[str], ids: list[list[int]]) -> None:
        # The library puts a blank before each text. Runs that begin with one go without it,
        # others after a line end, which is a border too; its ids are those of a lone line end.
        head = self.library.encode("\n")
        theirs = self.library.encode([r[1:] if r[0] == " " else "\n" + r for r in runs], num_threads=1)
        for r, mine, other in zip(runs, ids, theirs):
            if r == " ":
                other = head[:1]
            elif r[0] != " ":
                other = other[len(head) :]
            if mine != other:
                raise AssertionError(f"ids differ from the library's for {r[:200]!r}")

    def segment_short(self, runs: list[str]) -> dict[str, list[int]]:
        """``segment`` for many short runs at once; runs with unknown characters are left out.

        Each row has the symbols of a run, and an agenda of the ranks of its pairs.
        A step takes the best entry of every row (the leftmost of equals), puts what
        the pair makes in its place and ranks the two pairs that this changes.
        """
        if not runs:
            return {}
        lengths = np.array([len(r) for r in runs])
        width = int(lengths.max())
        chars = np.frombuffer("".join(runs).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        symbols = np.full((len(runs), width + 1), -1, dtype=np.int32)
        inside = np.arange(width + 1) < lengths[:, None]
        symbols[inside] = self._symbol[chars]
        known = ((symbols >= 0) == inside).all(axis=1)
        runs = [r for r, k in zip(runs, known) if k]
        symbols, rows = symbols[known], np.arange(len(runs))
        if not runs:
            return {}
        agenda, made = self._look_up(symbols[:, :-1], symbols[:, 1:])
        done = np.empty_like(symbols)
        places = np.arange(width + 1)
        while len(rows):
            at = agenda.argmin(axis=1)
            every = np.arange(len(rows))
            open_ = agenda[every, at] < _NO_PAIR
            done[rows[~open_]] = symbols[~open_]
            rows, symbols, agenda, made, at = rows[open_], symbols[open_], agenda[open_], made[open_], at[open_]
            if not len(rows):
                break
            every = np.arange(len(rows))
            symbols[every, at] = made[every, at]
            # All behind the merged pair move up by one.
            source = np.minimum(places + (places > at[:, None]), width)
            symbols = np.take_along_axis(symbols, source, axis=1)
            symbols[:, -1] = -1
            source = np.minimum(places[:-1] + (places[:-1] >= at[:, None]), width - 1)
            agenda = np.take_along_axis(agenda, source, axis=1)
            made = np.take_along_axis(made, source, axis=1)
            agenda[:, -1] = _NO_PAIR
            for place in (at - 1, at):
                real = np.flatnonzero(place >= 0)
                left, right = symbols[real, place[real]], symbols[real, place[real] + 1]
                agenda[real, place[real]], made[real, place[real]] = self._look_up(left, right)
        count = (done >= 0).sum(axis=1).tolist()
        return {r: ids[:n] for r, ids, n in zip(runs, done.tolist(), count)}

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left.astype(np.int64) << 20 | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        pair = (self._keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(pair, self._ranks[at], _NO_PAIR), self._made[at]

    def segment(self, run: str) -> list[int]:
        """Merge the pair of neighbours with the best score, the leftmost of equals, until none merges.

        Neighbours that make a piece stand on the agenda by score and place. A taken
        entry is out of date if either symbol has changed since. Symbols are linked
        to both neighbours; a merged one keeps the place of its left part.
        """
        order = self.order
        symbols: list[str | None] = list(run)
        n = len(symbols)
        if n > 1:
            after = list(range(1, n + 1))
            before = list(range(-1, n - 1))
            agenda = []
            for i in range(n - 1):
                pair = run[i : i + 2]
                if pair in order:
                    agenda.append((order[pair], i, i + 1, pair))
            heapify(agenda)
            while agenda:
                _, left, right, pair = heappop(agenda)
                one, two = symbols[left], symbols[right]
                if one is None or two is None or len(one) + len(two) != len(pair):
                    continue
                symbols[left], symbols[right] = pair, None
                after[left] = following = after[right]
                if following < n:
                    before[following] = left
                    longer = pair + symbols[following]
                    if longer in order:
                        heappush(agenda, (order[longer], left, following, longer))
                previous = before[left]
                if previous >= 0:
                    longer = symbols[previous] + pair
                    if longer in order:
                        heappush(agenda, (order[longer], previous, left, longer))
        ids = []
        for s in symbols:
            if s is None:
                continue
            if s in self.ids:
                ids.append(self.ids[s])
            else:
                ids.extend(self.bytes[b] for b in s.encode("utf-8"))
        return ids


_NO_PAIR = np.int32(np.iinfo(np.int32).max)


def encode_texts(
    docs: DataFrame, vocabulary: str, text: str = "text", check: bool = True, column: str = "token_ids"
) -> DataFrame:
    """The rows of ``docs`` with their ids, begin and end ids included, as little-endian 32-bit numbers.

    Beside ``column``: ``decoded``, the library's text of the ids. With ``check``
    the distinct new runs of every batch are encoded by the library as well, and the
    job fails where one id differs.

    Defined cases: a NULL text counts as empty and has the ids of begin and end
    only. ``vocabulary`` is the path of the file on every worker. Columns of
    ``docs`` with the names of results are replaced.
    """
    kept = [c for c in docs.columns if c not in (column, "decoded")]
    rows = docs.select(*kept)
    at = kept.index(text)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), f"`{column}` binary", "decoded string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, coded, decoded in _encoded(batches, at, vocabulary, check):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(coded, pa.binary()), pa.array(decoded, pa.string())],
                [*kept, column, "decoded"],
            )

    return rows.mapInArrow(run, schema)


def _encoded(
    batches: Iterator[pa.RecordBatch], at: int, vocabulary: str, check: bool
) -> Iterator[tuple[pa.RecordBatch, list[bytes], list[str]]]:
    """Slices of the batches with the ids of the texts in column ``at`` and what these decode to."""
    encoder = _encoder(vocabulary, check)
    for batch in batches:
        for few in small_slices(batch, at):
            ids = encoder.encode_batch([t or "" for t in few.column(at).to_pylist()])
            coded = [encoder.head + x.astype("<u4").tobytes() + encoder.tail for x in ids]
            decoded = encoder.library.decode([[encoder.begin, *x.tolist(), encoder.end] for x in ids], num_threads=1)
            yield few, coded, decoded


@lru_cache(maxsize=1)
def _encoder(path: str, check: bool) -> PieceEncoder:
    """One encoder for a worker process, whose memory of runs serves all its tasks."""
    return PieceEncoder(path, check)


def digest_texts(docs: DataFrame, vocabulary: str, check: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document's ids and their text.

    Digests are made where the ids are, so neither ids nor texts leave the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for few, coded, decoded in _encoded(batches, 1, vocabulary, check):
            yield pa.RecordBatch.from_arrays(
                [
                    few.column(0),
                    pa.array([len(b) // 4 for b in coded], pa.int64()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in coded]),
                    pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in decoded]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
