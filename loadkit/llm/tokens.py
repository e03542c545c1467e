"""Token counts from a finite-state form of a byte-fallback BPE tokenizer.

In a vocabulary whose pieces hold the word mark only at their beginning (or
are runs of it), no merge crosses the place where a space follows another
character. There the tokenizer is in one known state whatever came before. The
transducer built here has that boundary state and one transition for each
segment between two boundaries, annotated with the number of tokens that the
merges emit on it. Transitions are determinised as segments occur, all new
ones of a slice at once, and are kept for the next.

A chunk of a text acts on states as a map: what it does before its first
boundary depends on the state it is entered in, everything after does not. So
(bytes before the first boundary, tokens between the boundaries, bytes after
the last) describes the map, and maps compose associatively. Texts longer than
a chunk are reduced by a scan of such compositions.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.llm.textbytes import hash_spans, prefix_hashes, slices

MARK = "▁"
CHUNK = 4 << 20
MOST_KEPT = 4_000_000
LONG = 48


class Transducer:
    """Counts the tokens of segments; built from the pieces and scores of the model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        scores = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not special(i)}
        if any(MARK in p.lstrip(MARK) or (p.startswith(MARK * 2) and p.strip(MARK)) for p in scores):
            raise ValueError("pieces cross a boundary between words")
        symbols = {p: i for i, p in enumerate(dict.fromkeys([*scores, *(c for p in scores for c in p)]))}
        order = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = {}
        for piece, score in scores.items():
            for k in range(1, len(piece)):
                a, b = symbols.get(piece[:k]), symbols.get(piece[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (order[score], symbols[piece])
        self.codes = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[c][0] for c in self.codes.tolist()] + [2**31 - 1], np.int64)
        self.merged = np.array([pairs[c][1] for c in self.codes.tolist()] + [-1], np.int64)
        self.pairs = pairs
        # tokens of a symbol that is left: one, or its bytes if it is no piece
        self.emits = np.array([1 if p in scores else len(p.encode()) for p in symbols], np.int64)
        self.chars = {ord(p): i for p, i in symbols.items() if len(p) == 1}
        self.char_codes = np.array(sorted(self.chars), np.int64)
        self.char_symbols = np.array([self.chars[c] for c in sorted(self.chars)], np.int64)
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    # the transitions: (segment) -> tokens emitted

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left << 32 | right
        at = np.searchsorted(self.codes, code)
        at[at == len(self.codes)] = 0
        return np.where((self.codes[at] == code) & (left >= 0) & (right >= 0), at, len(self.codes))

    def _long(self, symbols: list[int], unknown: int) -> int:
        """Merges of one long segment, best pair first, by a heap."""
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        heap: list = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(symbols) and symbols[i] >= 0 and symbols[j] >= 0 and (m := self.pairs.get(symbols[i] << 32 | symbols[j])):
                heapq.heappush(heap, (m[0], i, j, symbols[i], symbols[j], m[1]))

        for i in range(len(symbols)):
            offer(i)
        gone = [False] * (len(symbols) + 1)
        while heap:
            _, i, j, a, b, m = heapq.heappop(heap)
            if gone[i] or gone[j] or after[i] != j or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], gone[j], after[i] = m, True, after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return unknown + sum(int(self.emits[s]) for i, s in enumerate(symbols) if not gone[i] and s >= 0)

    def emitted(self, segments: list[bytes]) -> np.ndarray:
        """Tokens of each segment, given without the word mark that begins it."""
        texts = [MARK + s.decode("utf-8", "replace").replace(" ", MARK) for s in segments]
        lengths = np.array([len(t) for t in texts], np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.char_codes, points), len(self.char_codes) - 1)
        symbol = np.where(self.char_codes[at] == points, self.char_symbols[at], -1)
        owner = np.repeat(np.arange(len(texts)), lengths)
        fallback = np.where(symbol < 0, 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), 0)
        unknown = np.bincount(owner, fallback, len(texts)).astype(np.int64)
        total = unknown.copy()
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        for i in np.flatnonzero(lengths > LONG):
            total[i] = self._long(symbol[bounds[i] : bounds[i + 1]].tolist(), int(unknown[i]))
        keep = np.repeat(lengths <= LONG, lengths)
        symbol, owner = symbol[keep], owner[keep]
        if not len(symbol):
            return total

        def looked_up(where: np.ndarray) -> np.ndarray:
            here = where[where + 1 < len(symbol)]
            found = np.full(len(where), len(self.codes))
            same = owner[here] == owner[here + 1]
            found[: len(here)] = np.where(same, self._lookup(symbol[here], symbol[here + 1]), len(self.codes))
            return found

        pair = looked_up(np.arange(len(symbol)))
        while len(symbol):
            rank = self.ranks[pair]
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            size = np.diff(np.concatenate([first, [len(symbol)]]))
            best = np.minimum.reduceat(rank, first)
            over = best == self.ranks[-1]
            # the leftmost best pair of every segment that still has one
            place = np.flatnonzero((rank == np.repeat(best, size)) & np.repeat(~over, size))
            place = place[np.concatenate([[True], owner[place][1:] != owner[place][:-1]])] if len(place) else place
            done = np.repeat(over, size)
            left = symbol[done]
            np.add.at(total, owner[done], np.where(left >= 0, self.emits[left], 0))
            symbol[place] = self.merged[pair[place]]
            keep = ~done
            keep[place + 1] = False
            changed = np.zeros(len(symbol), bool)
            changed[place] = True
            symbol, owner, pair, changed = symbol[keep], owner[keep], pair[keep], changed[keep]
            changed[:-1] |= changed[1:] & (owner[:-1] == owner[1:])
            redo = np.flatnonzero(changed)
            if len(redo):
                pair[redo] = looked_up(redo)
        return total

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of the segments from each start to each end, by the transitions kept so far and new ones."""
        hashes = hash_spans(prefix_hashes(data), starts, ends)
        unique, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        result = np.full(len(unique), -1, np.int64)
        for keys, values in self.runs:
            at = np.minimum(np.searchsorted(keys, unique), len(keys) - 1)
            hit = keys[at] == unique
            result[hit] = values[at[hit]]
        new = np.flatnonzero(result < 0)
        if len(new):
            raw = data.tobytes()
            result[new] = self.emitted([raw[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)])
            self._keep(unique[new], result[new])
        return result[back]

    def _keep(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Runs of sorted transitions, each much longer than the next; all are forgotten when they are too many."""
        if sum(len(k) for k, _ in self.runs) + len(keys) > MOST_KEPT:
            self.runs = []
        self.runs.append((keys, values.astype(np.int32)))
        while len(self.runs) > 1 and len(self.runs[-2][0]) < 4 * len(self.runs[-1][0]):
            (k1, v1), (k2, v2) = self.runs.pop(), self.runs.pop()
            keys, values = np.concatenate([k1, k2]), np.concatenate([v1, v2])
            order = np.argsort(keys)
            self.runs.append((keys[order], values[order]))

    # texts

    def of_texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a slice. A text has a word mark put before it; empty ones have no tokens."""
        if not len(data):
            return np.zeros(len(offsets) - 1, np.int64)
        space = data == 0x20
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        heads = offsets[:-1][np.diff(offsets) > 0]
        begin[heads] = True
        starts = np.flatnonzero(begin)
        ends = np.concatenate([starts[1:], [len(data)]])
        owner = np.searchsorted(offsets, starts, "right") - 1
        starts = starts + 1
        starts[np.searchsorted(starts, heads + 1)] -= 1  # the mark before a text is not one of its bytes
        return np.bincount(owner, self.counts(data, starts, ends), len(offsets) - 1).astype(np.int64)

    def chunk_map(self, chunk: bytes) -> tuple[bytes, int | None, bytes]:
        """What a chunk does: (before its first boundary, tokens up to its last boundary, after it); None without a boundary."""
        data = np.frombuffer(chunk, np.uint8)
        space = data == 0x20
        bounds = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        if not len(bounds):
            return chunk, None, b""
        inner = int(self.counts(data, bounds[:-1] + 1, bounds[1:]).sum()) if len(bounds) > 1 else 0
        return chunk[: bounds[0]], inner, chunk[bounds[-1] :]

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of two chunks one after the other."""
        if a[1] is None and b[1] is None and not (b[0][:1] == b" " and a[0][-1:] not in (b" ", b"")):
            return a[0] + b[0], None, b""
        if a[1] is None:
            if b[0][:1] == b" " and a[0][-1:] not in (b" ", b""):  # a boundary lies between the chunks
                return (a[0], 0, b[0]) if b[1] is None else (a[0], self._segment(b[0]) + b[1], b[2])
            return a[0] + b[0], b[1], b[2]
        if b[0][:1] == b" " and a[2][-1:] != b" ":
            n = a[1] + self._segment(a[2])
            return (a[0], n, b[0]) if b[1] is None else (a[0], n + self._segment(b[0]) + b[1], b[2])
        return (a[0], a[1], a[2] + b[0]) if b[1] is None else (a[0], a[1] + self._segment(a[2] + b[0]) + b[1], b[2])

    def _segment(self, segment: bytes) -> int:
        data = np.frombuffer(segment, np.uint8)
        return int(self.counts(data, np.array([1]), np.array([len(data)]))[0])

    def of_long_text(self, text: bytes, chunk: int = CHUNK) -> int:
        """Tokens of one text by a scan over the maps of its chunks."""
        if not text:
            return 0
        text = b" " + text
        maps = [self.chunk_map(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        head, inner, tail = maps[0]
        return self._segment(head) + (0 if inner is None else inner + self._segment(tail))


_kept: dict[str, Transducer] = {}


def transducer(model_file: str) -> Transducer:
    if model_file not in _kept:
        _kept.clear()
        _kept[model_file] = Transducer(model_file)
    return _kept[model_file]


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row, as the model's own library counts them.

    Works on rows where they are: no shuffle. Null texts count as empty, and
    empty ones have no tokens. Null ids and repeated rows are kept. Other
    columns are not read. Texts beyond ``CHUNK`` bytes go through chunk maps.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(model_file)
        for batch in batches:
            texts = batch.column("_text")
            if pc.any(pc.match_substring(texts, MARK)).as_py():  # the mark itself reads as a space
                texts = pc.replace_substring(texts, MARK, " ")
            found = []
            for _, _, data, offsets in slices(texts, CHUNK):
                if len(data) > CHUNK:
                    found.append(np.array([machine.of_long_text(data.tobytes())]))
                else:
                    found.append(machine.of_texts(data, offsets))
            tokens = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(tokens, pa.int64())], names=["_id", "n_tokens"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col).cast("string")
    slim = docs.select(F.struct(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n")).alias("_id"), text.alias("_text"))
    counted = slim.mapInArrow(run, f"_id struct<id:{kind},n:bigint>, n_tokens bigint")
    return counted.select(
        F.col("_id.id").alias(id_col), F.col("_id.n").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
