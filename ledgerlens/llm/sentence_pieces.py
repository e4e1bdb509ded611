"""Encoding and decoding by a BPE piece model, in vectorised merge rounds.

A slice of texts becomes one flat array of symbols. It is cut into words
wherever two neighbouring characters stand together in no piece, so that no
merge crosses a cut; equal words are merged once. In every round each word
looks up the ranks of its pairs, takes the smallest (a segmented minimum) and
merges all its pairs of that rank, from the left; then the array is compacted,
and words without a pair leave it. Characters that are no piece become bytes.

Merging one pair at a time, best score first and leftmost among equals, gives
the same: a round differs from that only if a merge makes a pair of the same
or a better rank beside another merge of the round. Words where that happens
(runs of blanks, whose pieces all have one score), and words of more than
``LONGEST`` symbols, where rounds times length would grow with the square, are
finished one merge at a time with a queue.

Decoding gathers the bytes of all ids at once. The rules are those of the
sentencepiece library for models without a normaliser table, with a blank put
before the text, blanks kept, and byte fallback; other models are refused.

Null and empty texts have only the begin and end ids and decode to the empty
text. Bytes that are not UTF-8 read as U+FFFD. Null ids and repeated rows stay
rows of their own; an empty table gives an empty result; other columns than
those asked for are ignored, whatever their names. Texts of any length are
taken whole, in parts that end at a cut between words.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm.common import by_value, distinct, slices, spread

by_value(__name__)

BLANK = "▁"
UNKNOWN_TEXT = " ⁇ "
CODE_POINTS = 0x110000
# No rank: the pair is no piece.
NEVER = np.iinfo(np.int32).max
# Symbols of a word that rounds work on; characters and ids that one step holds.
LONGEST = 1 << 15
PART = 1_000_000
# Kinds of ids.
PIECE, BYTE, CONTROL, UNKNOWN = range(4)


def model_file(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass
class PieceModel:
    """Tables made from a model file; their size follows the vocabulary."""

    pieces: list[str]
    kinds: np.ndarray
    scores: np.ndarray
    bos: int
    eos: int
    made: dict = field(default_factory=dict, repr=False)

    @property
    def size(self) -> int:
        return len(self.pieces)

    def __getstate__(self) -> dict:
        # Tasks make their own tables.
        return {**self.__dict__, "made": {}}

    def tables(self) -> dict:
        if not self.made:
            self.made.update(self.build())
        return self.made

    def build(self) -> dict:
        size, normal = self.size, [i for i, k in enumerate(self.kinds) if k == PIECE]
        known = {self.pieces[i]: i for i in normal}
        # A symbol is a piece's id, or, beyond all ids, a character that is no piece.
        symbol = np.arange(CODE_POINTS, dtype=np.int64) + size
        for text, i in known.items():
            if len(text) == 1:
                symbol[ord(text)] = i
        beside = sorted({c for p in known if len(p) > 1 for c in p})
        classes = np.zeros(CODE_POINTS, np.int64)
        classes[[ord(c) for c in beside]] = np.arange(1, len(beside) + 1)
        width = len(beside) + 1
        together = np.zeros(width * width, bool)
        # Equal scores have one rank.
        ranks = dict(zip(normal, np.unique(-self.scores[normal], return_inverse=True)[1].tolist()))
        pairs = []
        for text, i in known.items():
            at = classes[[ord(c) for c in text]]
            together[at[:-1] * width + at[1:]] = True
            for cut in range(1, len(text)):
                halves = [known.get(h, ord(h) + size if len(h) == 1 else None) for h in (text[:cut], text[cut:])]
                if None not in halves:
                    pairs.append((halves[0] * (size + CODE_POINTS) + halves[1], ranks[i], i))
        table = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        bytes_of = [UNKNOWN_TEXT.encode()] * size
        byte_ids = np.full(256, -1, np.int64)
        for i, (text, kind) in enumerate(zip(self.pieces, self.kinds)):
            if kind == PIECE:
                bytes_of[i] = text.replace(BLANK, " ").encode()
            elif kind == BYTE:
                byte_ids[int(text[3:5], 16)] = i
                bytes_of[i] = bytes([int(text[3:5], 16)])
            elif kind == CONTROL:
                bytes_of[i] = b""
        lengths = np.array([len(b) for b in bytes_of], np.int64)
        return {
            "symbol": symbol, "classes": classes, "width": width, "together": together, "keys": table[:, 0].copy(),
            "ranks": table[:, 1].astype(np.int32), "into": table[:, 2].copy(), "byte_ids": byte_ids, "lengths": lengths,
            "offsets": np.cumsum(lengths) - lengths, "flat": np.frombuffer(b"".join(bytes_of), np.uint8),
            "opens_blank": np.array([k == PIECE and p.startswith(BLANK) for p, k in zip(self.pieces, self.kinds)]),
        }


def read_model(path: str | None = None) -> PieceModel:
    """Read a model file; refuse what these rules do not cover."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path or model_file(), "rb") as f:
        proto.ParseFromString(f.read())
    train, normal = proto.trainer_spec, proto.normalizer_spec
    kind_of = {1: PIECE, 2: UNKNOWN, 3: CONTROL, 6: BYTE}
    if train.model_type != 2 or not train.byte_fallback or train.treat_whitespace_as_suffix:
        raise ValueError("only BPE models with byte fallback and blanks as prefixes")
    if normal.precompiled_charsmap or not normal.add_dummy_prefix or normal.remove_extra_whitespaces or not normal.escape_whitespaces:
        raise ValueError("only models that put a blank before the text and change nothing else")
    if any(p.type not in kind_of for p in proto.pieces) or sum(p.type == 6 for p in proto.pieces) != 256:
        raise ValueError("only pieces, controls, one unknown id and all bytes")
    pieces = [p.piece for p in proto.pieces]
    where = {p: i for i, p in enumerate(pieces)}
    kinds = np.array([kind_of[p.type] for p in proto.pieces], np.int8)
    scores = np.array([p.score for p in proto.pieces], np.float32)
    return PieceModel(pieces, kinds, scores, where[train.bos_piece or "<s>"], where[train.eos_piece or "</s>"])


class Merger:
    """Symbols of many words to ids."""

    def __init__(self, model: PieceModel):
        self.t, self.size = model.tables(), model.size
        self.stride = model.size + CODE_POINTS
        self.as_dict: dict[int, tuple[int, int]] = {}

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair."""
        key, keys = left * self.stride + right, self.t["keys"]
        if not len(keys):
            return np.full(len(key), NEVER, np.int32), key
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, self.t["ranks"][at], NEVER), self.t["into"][at]

    def queue(self, symbols: list[int]) -> list[int]:
        """One word, one merge at a time."""
        if not self.as_dict:
            self.as_dict = dict(zip(self.t["keys"].tolist(), zip(self.t["ranks"].tolist(), self.t["into"].tolist())))
        n, symbols = len(symbols), list(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        waiting: list[tuple[int, int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (found := self.as_dict.get(symbols[i] * self.stride + symbols[j])):
                heapq.heappush(waiting, (found[0], i, j, symbols[i], symbols[j], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while waiting:
            _, i, j, left, right, into = heapq.heappop(waiting)
            if symbols[i] != left or symbols[j] != right or after[i] != j:
                continue
            symbols[i], symbols[j] = into, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [s for s in symbols if s >= 0]

    def merged(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final symbols and the word of each, in the order of words; ``word`` ascends."""
        done: list[tuple[np.ndarray, np.ndarray]] = []

        def finish(which: np.ndarray) -> None:
            for w in np.unique(word[which]).tolist():
                a, b = np.searchsorted(word, [w, w + 1])
                ids = self.queue(symbols[a:b].tolist())
                done.append((np.array(ids, np.int64), np.full(len(ids), w)))

        def keep(stay: np.ndarray) -> None:
            nonlocal symbols, word, rank, into
            symbols, word, rank, into = symbols[stay], word[stay], rank[stay], into[stay]

        rank, into = np.full(len(symbols), NEVER, np.int32), np.zeros(len(symbols), np.int64)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside], into[inside] = self.pairs(symbols[inside], symbols[inside + 1])
        length = np.bincount(word)[word] if len(word) else word
        if (length > LONGEST).any():
            finish(length > LONGEST)
            keep(length <= LONGEST)
        while len(symbols):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word))))
            if (over := least == NEVER).any():
                done.append((symbols[over], word[over]))
                keep(~over)
                least = least[~over]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == least)
            # Of pairs that share a symbol every second one merges, from the left.
            run = np.arange(len(at)) - np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, np.arange(len(at)), 0))
            at = at[run % 2 == 0]
            several = np.diff(word[at], prepend=-1) == 0
            several |= np.append(several[1:], False)
            if several.any():
                clash = self.clashes(symbols, word, into, least, at)
                if clash.any():
                    gone = np.isin(word, word[at[clash]])
                    finish(gone)
                    keep(~gone)
                    continue
            symbols[at] = into[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            now = np.cumsum(stay)[at] - 1
            keep(stay)
            # Only pairs with a new symbol have another rank.
            changed = np.concatenate([now, now[now > 0] - 1])
            rank[changed] = NEVER
            changed = changed[changed + 1 < len(symbols)]
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed], into[changed] = self.pairs(symbols[changed], symbols[changed + 1])
        if not done:
            return symbols, word
        all_symbols, all_words = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(all_words, kind="stable")
        return all_symbols[order], all_words[order]

    def clashes(self, symbols: np.ndarray, word: np.ndarray, into: np.ndarray, least: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which merges of this round make a pair that would come before the rest of the round."""
        found = np.zeros(len(at), bool)
        right = np.flatnonzero(at + 2 < len(word))
        right = right[word[at[right] + 2] == word[at[right]]]
        found[right] = self.pairs(into[at[right]], symbols[at[right] + 2])[0] <= least[at[right]]
        left = np.flatnonzero(at > 0)
        left = left[word[at[left] - 1] == word[at[left]]]
        beside = symbols[at[left] - 1]
        # The symbol on the left may be one that this round has made.
        made = (left > 0) & (at[left - 1] == at[left] - 2)
        beside = np.where(made, into[at[left - 1]], beside)
        found[left] |= self.pairs(beside, into[at[left]])[0] <= least[at[left]]
        return found


class Encoder:
    """Ids of texts."""

    def __init__(self, model: PieceModel):
        self.t, self.size, self.merger = model.tables(), model.size, Merger(model)

    def cut(self, points: np.ndarray) -> np.ndarray:
        """Whether a word begins at each character but the first."""
        at = self.t["classes"][points]
        return ~self.t["together"][at[:-1] * self.t["width"] + at[1:]]

    def parts(self, text: str) -> Iterator[str]:
        """A text in parts of about ``PART`` characters, each but the first beginning with a word."""
        start = 0
        while len(text) - start > PART:
            stop = start + PART
            while stop < len(text):
                cuts = np.flatnonzero(self.cut(np.frombuffer(text[stop - 1 : stop + PART].encode("utf-32-le"), np.uint32)))
                if len(cuts):
                    stop += int(cuts[0])
                    break
                stop = min(stop + PART, len(text))
            yield text[start:stop]
            start = stop
        yield text[start:]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin (one entry more than texts)."""
        ready = [BLANK + t.replace(" ", BLANK) if t else "" for t in texts]
        if sum(map(len, ready)) <= 2 * PART:
            return self.some(ready)
        made, sizes = [], []
        for text in ready:
            ids = [self.some([p])[0] for p in self.parts(text)]
            made += ids
            sizes.append(sum(map(len, ids)))
        return np.concatenate(made), np.concatenate([[0], np.cumsum(sizes)])

    def some(self, ready: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(ready).encode("utf-32-le"), np.uint32).astype(np.int64)
        text_begin = np.concatenate([[0], np.cumsum([len(t) for t in ready])]).astype(np.int64)
        if not len(points):
            return np.empty(0, np.int64), np.zeros(len(ready) + 1, np.int64)
        opens = np.concatenate([[True], self.cut(points)])
        opens[text_begin[:-1][np.diff(text_begin) > 0]] = True
        begin = np.flatnonzero(opens)
        length = np.diff(np.append(begin, len(points)))
        chosen, same = distinct(points, begin, length)
        symbols = self.t["symbol"][points[spread(begin[chosen], length[chosen])]]
        ids, word = self.as_ids(*self.merger.merged(symbols, np.repeat(np.arange(len(chosen)), length[chosen])))
        count = np.bincount(word, minlength=len(chosen))
        out = ids[spread((np.cumsum(count) - count)[same], count[same])]
        ends = np.concatenate([[0], np.cumsum(count[same])])
        return out, ends[np.searchsorted(begin, text_begin)]

    def as_ids(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Write the bytes of characters that are no piece."""
        other = np.flatnonzero(symbols >= self.size)
        if not len(other):
            return symbols, word
        chars, which = np.unique(symbols[other] - self.size, return_inverse=True)
        written = [chr(c).encode() for c in chars.tolist()]
        size = np.ones(len(symbols), np.int64)
        size[other] = np.array([len(b) for b in written])[which]
        at = np.cumsum(size) - size
        out = np.repeat(symbols, size)
        for k in range(4):
            value = self.t["byte_ids"][[b[k] if k < len(b) else 0 for b in written]]
            have = size[other] > k
            out[at[other][have] + k] = value[which[have]]
        return out, np.repeat(word, size)


class Decoder:
    """Texts of ids."""

    def __init__(self, model: PieceModel):
        self.t, self.kinds, self.size = model.tables(), model.kinds, model.size

    def gathered(self, ids: np.ndarray) -> bytes:
        t = self.t
        parts = (ids[i : i + PART] for i in range(0, len(ids), PART))
        return b"".join(t["flat"][spread(t["offsets"][p], t["lengths"][p])].tobytes() for p in parts)

    def one_by_one(self, ids: np.ndarray) -> str:
        """Runs of bytes that are no text read as U+FFFD, byte by byte."""
        out, run = [], b""

        def flush() -> None:
            nonlocal run
            while run:
                for n in range(1, 5):
                    try:
                        out.append(run[:n].decode())
                    except UnicodeDecodeError:
                        continue
                    break
                else:
                    out.append("�")
                    n = 1
                run = run[n:]

        for i in ids.tolist():
            if self.kinds[i] == BYTE:
                run += self.gathered(np.array([i]))
            else:
                flush()
                out.append(self.gathered(np.array([i])).decode())
        flush()
        return "".join(out)

    def __call__(self, ids: np.ndarray, begin: np.ndarray) -> list[str]:
        """The text of each row of ids."""
        if len(ids) and not (0 <= ids.min() and ids.max() < self.size):
            raise ValueError("an id beyond the vocabulary")
        out = []
        whole = self.gathered(ids)
        ends = np.concatenate([[0], np.cumsum(self.t["lengths"][ids])])[begin].tolist()
        for i, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist())):
            row = ids[a:b]
            said = np.flatnonzero(self.kinds[row] != CONTROL)
            text = None
            if not len(said) or said[-1] - said[0] + 1 == len(said):
                try:
                    text = whole[ends[i] : ends[i + 1]].decode()
                except UnicodeDecodeError:
                    pass
            if text is None:
                text = self.one_by_one(row)
            out.append(text[1:] if len(said) and self.t["opens_blank"][row[said[0]]] else text)
        return out


IDS = "<u4"


def framed(ids: np.ndarray, begin: np.ndarray, bos: int | None, eos: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Put the begin and end ids around every row."""
    rows, extra = len(begin) - 1, (bos is not None) + (eos is not None)
    out = np.empty(len(ids) + rows * extra, ids.dtype)
    at = begin + np.arange(rows + 1) * extra
    row = np.repeat(np.arange(rows), np.diff(begin))
    out[np.arange(len(ids)) + row * extra + (bos is not None)] = ids
    if bos is not None:
        out[at[:-1]] = bos
    if eos is not None:
        out[at[1:] - 1] = eos
    return out, at


def encode(docs: DataFrame, model: PieceModel | None = None, keep: tuple[str, ...] = ("doc_id",), bos: bool = True, eos: bool = True) -> DataFrame:
    """Columns ``keep``, ``n_tokens`` and ``ids``, the ids of ``text`` as little-endian unsigned 32-bit integers."""
    model = model or read_model()
    given = docs.select(*keep, "text")
    schema = given.select(*keep, F.lit(0).cast("long").alias("n_tokens"), F.lit(b"").alias("ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model)
        ends = (model.bos if bos else None, model.eos if eos else None)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                ids, begin = framed(*encoder([t.decode("utf-8", "replace") for t in texts]), *ends)
                column = binary(ids.astype(IDS).tobytes(), begin * 4)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(np.diff(begin)), column], [*keep, "n_tokens", "ids"])

    return given.mapInArrow(run, schema)


def binary(body: bytes, ends: np.ndarray) -> pa.Array:
    """A column of byte strings that lie one after another."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(body)]).cast(pa.binary())


def decode(encoded: DataFrame, model: PieceModel | None = None) -> DataFrame:
    """Add ``decoded``, the text of the ids of each row; without ids the empty text."""
    model = model or read_model()
    schema = encoded.select("*", F.lit("").alias("decoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for batch in batches:
            for part, rows in slices(batch, "ids"):
                begin = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])])
                texts = decoder(np.frombuffer(b"".join(rows), IDS).astype(np.int64), begin)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def op11_pieces(docs: DataFrame) -> DataFrame:
    model = read_model()
    both = decode(encode(docs.select(col("doc_id").cast("long"), "text"), model), model)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
