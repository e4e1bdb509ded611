"""Token ids in files, by a canonical length-limited Huffman code.

Documents are ordered by id, tokenised, and cut into blocks of bounded size.
One code is made from the counts of all ids (package-merge keeps its words
within ``LIMIT`` bits; canonical, so that lengths are all a reader needs). Each
block is a file of its own: an index of its documents, a bit offset for every
``EVERY`` ids, and the bits. A reader decodes any block without the others, and
inside a block all stretches between checkpoints at once, by a table over the
next ``LIMIT`` bits.

Tasks exchange rows that stand for blocks, and map the blocks from files: no
task holds more than a block and one part of a text. A document longer than a
block goes on in the next; its checksum is joined from those of its pieces.

Null and empty texts have only the end id. A null id is sorted last and kept.
Repeated rows and texts under one id follow one another, by the hash of their
text. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ledgerlens.llm.common import by_value, mix64, pieces, slices, spread, stored
from ledgerlens.llm.language_model import shared_read, shared_write
from ledgerlens.session import scratch_path

by_value(__name__)

END_ID = 0
# Longest code word, ids between checkpoints and of one step of encoding, ids of a block, bytes of text in one range of documents,
# and blocks that a task packs or reads.
LIMIT = 18
EVERY = 1024
STRETCH = 64 * EVERY
BLOCK_IDS = 1_000_000
RANGE_BYTES = 64_000_000
TASK_BLOCKS = 4
# Characters of a long text that are encoded at once.
PART = 250_000
# Bytes of text of one step; bytes of pieces whose ids a task remembers, what an entry takes besides its ids, that of
# a long piece also besides its text, pieces learnt at once, and places of a table at first.
STEP_BYTES = 500_000
REMEMBERED_BYTES = 100_000_000
ENTRY, LONG_ENTRY = 80, 160
LEARNED = 20_000
PLACES = 1 << 16
# Bytes of a piece that two numbers tell exactly, with its length in the last byte; and the masks of the first 0 to 8 bytes.
SHORT = 15
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
MAGIC = 0x32464854
# What a byte is to the tokenizer's pattern: of letters and punctuation, those of ASCII are told.
OTHER, BLANK, FEED, LETTER, MARK = range(5)
BYTE_KINDS = np.full(256, OTHER, np.uint8)
BYTE_KINDS[33:127] = MARK
BYTE_KINDS[48:58] = OTHER
BYTE_KINDS[65:91] = BYTE_KINDS[97:123] = LETTER
BYTE_KINDS[[10, 32]] = FEED, BLANK
# White space that a tokenizer's pattern may join with a neighbouring blank, apart from blank and line feed.
ODD_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
# The first bytes of these.
ODD_BYTES = bytes([9, 11, 12, 13, *range(28, 32), 0xC2, 0xE1, 0xE2, 0xE3])


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def short_keys(data: bytes, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers for each stretch of 1 to ``SHORT`` bytes: its bytes, and its length; ``data`` has 16 bytes to spare."""
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    low = eight[begin] & MASKS[np.minimum(length, 8)]
    high = eight[begin + 8] & MASKS[np.maximum(length, 8) - 8]
    return low, high | length.astype(np.uint64) << np.uint64(56)


class Known:
    """Ids of pieces: of short ones, all of a step are looked up at once, without an object for any of them.

    Their two numbers are in a table with linear probing, so pieces are compared
    whole; no piece has the second number 0. Longer pieces are in a dictionary.
    For each there is where its ids begin among all ids, and in the lower half
    their number.
    """

    def __init__(self, kind: str):
        self.kind = kind
        self.clear()

    def clear(self) -> None:
        self.count, self.size, self.text = 0, 0, 0
        self.long: dict[bytes, int] = {}
        self.ids = np.empty(PLACES, self.kind)
        self.empty(PLACES)

    def empty(self, places: int) -> None:
        self.low, self.high, self.at = np.zeros(places, np.uint64), np.zeros(places, np.uint64), np.zeros(places, np.int64)

    def __len__(self) -> int:
        return self.count + len(self.long)

    @property
    def held(self) -> int:
        return self.count * ENTRY + len(self.long) * LONG_ENTRY + self.text + self.size * self.ids.itemsize

    def first(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (mix64(low ^ mix64(high)) & np.uint64(len(self.at) - 1)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Where the ids of short pieces are, -1 for those not known."""
        out, left, place = np.full(len(low), -1), np.arange(len(low)), self.first(low, high)
        while len(left):
            there = self.high[place]
            same = (there == high) & (self.low[place] == low)
            out[left[same]] = self.at[place[same]]
            go = np.flatnonzero(~same & (there != 0))
            left, low, high, place = left[go], low[go], high[go], (place[go] + 1) & (len(self.at) - 1)
        return out

    def place(self, low: np.ndarray, high: np.ndarray, at: np.ndarray) -> None:
        """Enter short pieces that differ and are not known."""
        place = self.first(low, high)
        while len(low):
            free = np.flatnonzero(self.high[place] == 0)
            # Of those that want one place, one has it.
            self.at[place[free]] = free
            won = free[self.at[place[free]] == free]
            for column, values in ((self.low, low), (self.high, high), (self.at, at)):
                column[place[won]] = values[won]
            go = np.ones(len(low), bool)
            go[won] = False
            low, high, at, place = low[go], high[go], at[go], (place[go] + 1) & (len(self.at) - 1)

    def add(self, new: list[bytes], ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        """Enter different pieces that are not known; of each, ``size`` ids from ``begin``."""
        if self.size + len(ids) > len(self.ids):
            grown = np.empty(2 * (self.size + len(ids)), self.kind)
            grown[: self.size] = self.ids[: self.size]
            self.ids = grown
        self.ids[self.size : self.size + len(ids)] = ids
        at = (begin + self.size << 32) + size
        self.size += len(ids)
        length = np.array([len(p) for p in new], np.int64)
        short = length <= SHORT
        for i in np.flatnonzero(~short).tolist():
            self.long[new[i]] = int(at[i])
            self.text += len(new[i])
        low, high = short_keys(b"".join([*new, bytes(16)]), (np.cumsum(length) - length)[short], length[short])
        self.count += len(low)
        places = len(self.at)
        while 5 * self.count > 3 * places:
            places *= 2
        if places > len(self.at):
            used = np.flatnonzero(self.high)
            had = self.low[used], self.high[used], self.at[used]
            self.empty(places)
            self.place(*had)
        self.place(low, high, at[short])


class Encoder:
    """Ids of whole texts by a byte-level tokenizer, remembering those of pieces.

    The tokenizer's pattern always cuts before a blank or line feed between two
    other characters, and between a letter and punctuation behind it, so ids of
    the pieces between such places are those of the text. A text with other
    white space beside a blank, or with an added token in it, goes to the
    tokenizer whole.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        # A task has one core; threads of its own would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4"
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = Known(self.kind)
        vocabulary = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.lengths[list(vocabulary.values())] = [len(name) for name in vocabulary]
        self.pieces_known = "ByteLevel(add_prefix_space=False" in str(self.tokenizer.pre_tokenizer) and self.tokenizer.normalizer is None
        # An added token with a line feed could come about where pieces are joined.
        self.pieces_known &= not any("\n" in a for a in self.added)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def regular(self, text: str, written: bytes) -> bool:
        if "  " in text or "\n " in text or " \n" in text or text.endswith(" "):
            return False
        odd = len(written.translate(None, ODD_BYTES)) < len(written) and ODD_SPACE.search(text)
        return self.pieces_known and not odd and not any(a in text for a in self.added)

    def learn(self, missing: list[bytes]) -> None:
        """Remember the ids of pieces, many in one text.

        A byte-level token stands for as many bytes as its name has letters, and
        no token crosses the blank or line feed before a piece, so running
        lengths tell where a piece ends. A piece that begins with neither is
        given a line feed, whose one id is left out again.
        """
        for at in range(0, len(missing), LEARNED):
            some = missing[at : at + LEARNED]
            added = np.array([p[0] not in b" \n" for p in some])
            given = [b"\n" + p if a else p for p, a in zip(some, added.tolist())]
            joined = [b"".join(given[i : i + 50]).decode() for i in range(0, len(given), 50)]
            found = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
            ids = np.concatenate([np.array(f.ids, self.kind) for f in found])
            ends = np.cumsum([len(p) for p in given])
            cuts = np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1
            begin = np.concatenate([[0], cuts[:-1]]) + added
            self.known.add(some, ids, begin, cuts - begin)

    def parts(self, text: str) -> Iterator[str]:
        """A text in parts of about ``PART`` characters, cut where the tokenizer's pattern always cuts.

        Without such a place, or with a pattern that isn't known, a part is longer.
        """
        start = 0
        while self.pieces_known and len(text) - start > PART:
            at = text.find(" ", start + PART)
            while 0 < at < len(text) - 1 and (text[at - 1].isspace() or text[at + 1].isspace()):
                at = text.find(" ", at + 1)
            if not 0 < at < len(text) - 1:
                break
            yield text[start:at]
            start = at
        yield text[start:]

    def __call__(self, texts: list[str]) -> list[bytes]:
        written = [t.encode() for t in texts]
        regular = [bool(t) and self.regular(t, w) for t, w in zip(texts, written)]
        found = iter(self.by_pieces([w for w, r in zip(written, regular) if r]))
        return [next(found) if r else self.whole(t) if t else b"" for t, r in zip(texts, regular)]

    def by_pieces(self, texts: list[bytes]) -> list[bytes]:
        """Ids of regular texts: those of their distinct pieces, put in their places."""
        edges = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        if not edges[-1]:
            return []
        data = b"".join([*texts, bytes(16)])
        # A piece begins with its blank, a single line feed or punctuation; the first of a text may have none of them.
        kinds = BYTE_KINDS[np.frombuffer(data, np.uint8)[: edges[-1]]]
        opens = kinds == BLANK
        opens[1:] |= (kinds[1:] == MARK) & (kinds[:-1] == LETTER)
        opens[1:-1] |= (kinds[1:-1] == FEED) & (kinds[:-2] != FEED) & (kinds[2:] != FEED)
        opens[edges[:-1]] = True
        begin = np.flatnonzero(opens)
        length = np.diff(begin, append=edges[-1])
        if self.known.held > REMEMBERED_BYTES:
            self.known.clear()
        short, long = np.flatnonzero(length <= SHORT), np.flatnonzero(length > SHORT)
        low, high = short_keys(data, begin[short], length[short])
        at = np.full(len(begin), -1)
        at[short] = self.known.find(low, high)
        apart = [data[b : b + n] for b, n in zip(begin[long].tolist(), length[long].tolist())]
        new = np.flatnonzero(at[short] < 0)
        told = [data[b : b + n] for b, n in zip(begin[short[new]].tolist(), length[short[new]].tolist())]
        missing = [*dict.fromkeys(told), *(p for p in dict.fromkeys(apart) if p not in self.known.long)]
        # Line feeds at an end would join those of a neighbour.
        alone = [p[-1] == 10 or p[:2] == b"\n\n" for p in missing]
        self.learn([p for p, a in zip(missing, alone) if not a])
        for piece in (p for p, a in zip(missing, alone) if a):
            ids = np.frombuffer(self.whole(piece.decode()), self.kind)
            self.known.add([piece], ids, np.zeros(1, np.int64), np.array([len(ids)]))
        at[short[new]] = self.known.find(low[new], high[new])
        at[long] = [self.known.long[p] for p in apart]
        size = at & 0xFFFFFFFF
        out = self.known.ids[spread(at >> 32, size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(begin, edges)].tolist()
        return [out[a:b].tobytes() for a, b in zip(ends, ends[1:])]


# Blocks, and with seq -1 how often a task has met each id.
BLOCKS = "part long, seq long, docs long, ids long, id array<int>, n array<long>"
HEADER = 6


def block_name(part: int, seq: int) -> str:
    return f"block-{part:08d}-{seq:08d}"


@dataclass
class Block:
    """Ids of consecutive documents; of the first one ``before`` ids are in earlier blocks, the last goes on if ``more``."""

    doc_ids: list
    sizes: list[int]
    ids: np.ndarray
    before: int
    more: bool

    def index(self) -> list[np.ndarray]:
        known, null = [d or 0 for d in self.doc_ids], [d is None for d in self.doc_ids]
        return [np.array(known, np.int64), np.array(null, np.uint64), np.array(self.sizes, np.uint64)]

    def header(self, size: int) -> np.ndarray:
        return np.array([MAGIC, len(self.doc_ids), len(self.ids), size, self.before, int(self.more)], np.uint64)


class Open:
    """The block that a task is filling."""

    def __init__(self, kind: str):
        self.kind, self.doc_ids, self.sizes, self.held, self.size, self.before = kind, [], [], [], 0, 0

    def begin(self, doc_id: int | None) -> None:
        self.doc_ids.append(doc_id)
        self.sizes.append(0)

    def add(self, ids: bytes) -> None:
        n = len(ids) // np.dtype(self.kind).itemsize
        self.held.append(ids)
        self.sizes[-1] += n
        self.size += n

    def close(self, more: bool) -> Block:
        """What is there; a document that goes on stays open."""
        block = Block(self.doc_ids, self.sizes, np.frombuffer(b"".join(self.held), self.kind), self.before, more)
        last, had = self.doc_ids[-1], self.sizes[-1] + (self.before if len(self.sizes) == 1 else 0)
        self.__init__(self.kind)
        if more:
            self.begin(last)
            self.before = had
        return block


def tokenised(definition: str, per_block: int, folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write the ids of all documents in their order, block by block, and count them.

    A block ends with the document, or the part of a long text, that reaches
    ``per_block`` ids, so it holds no more than that and one part.
    """
    schema = pa.schema([
        ("part", pa.int64()), ("seq", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64()), ("id", pa.list_(pa.int32())), ("n", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(definition)
        end = np.array([END_ID], encode.kind).tobytes()
        part, seq, now = TaskContext.get().partitionId(), 0, Open(encode.kind)
        counts = np.zeros(len(encode.lengths), np.int64)

        def written(block: Block) -> pa.RecordBatch:
            nonlocal counts, seq
            # Filled up to whole words.
            body = zstandard.ZstdCompressor(level=1).compress(block.ids.tobytes())
            body += bytes(-len(body) % 8)
            shared_write(f"{folder}/raw", block_name(part, seq), [block.header(len(body) // 8), *block.index(), np.frombuffer(body, np.uint64)])
            counts += np.bincount(block.ids, minlength=len(counts))
            row = {"part": part, "seq": seq, "docs": len(block.doc_ids), "ids": len(block.ids), "id": None, "n": None}
            seq += 1
            return pa.RecordBatch.from_pylist([row], schema)

        def encoded(batch: pa.RecordBatch) -> Iterator[tuple[int | None, Iterator[bytes]]]:
            for some, texts in slices(batch, "text", STEP_BYTES):
                doc_ids, read = some.column("doc_id").to_pylist(), [t.decode("utf-8", "replace") for t in texts]
                if len(read) == 1 and len(read[0]) > PART:
                    yield doc_ids[0], (encode([t])[0] for t in encode.parts(read[0]))
                else:
                    yield from zip(doc_ids, ([ids] for ids in encode(read)))

        for batch in batches:
            for doc_id, found in encoded(batch):
                now.begin(doc_id)
                for ids in found:
                    if now.size >= per_block:
                        yield written(now.close(True))
                    now.add(ids)
                now.add(end)
                if now.size >= per_block:
                    yield written(now.close(False))
        if now.doc_ids:
            yield written(now.close(False))
        some = np.flatnonzero(counts)
        total = {"part": part, "seq": -1, "docs": 0, "ids": 0, "id": some.tolist(), "n": counts[some].tolist()}
        yield pa.RecordBatch.from_pylist([total], schema)

    return run


def summed(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The counts of many tasks, added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            ids, n = (batch.column(c).flatten().to_numpy() for c in ("id", "n"))
            np.add.at(counts, ids, n)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], ["id", "n"])

    return run


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Lengths of an optimal prefix code with words of at most ``limit`` bits (package-merge); 0 for ids not used.

    In each round neighbours of the sorted list are packed in pairs and merged
    with the single ids; an id's length is how often it is among the first
    2 n - 2 entries of the rounds.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    if n > 2**limit:
        raise ValueError("more ids than code words of this length")
    order = used[np.argsort(counts[used], kind="stable")]
    single = counts[order].astype(np.float64)
    rounds, packages = [], np.empty(0)
    for _ in range(limit):
        merged = np.concatenate([single, packages])
        at = np.argsort(merged, kind="stable")
        rounds.append(at)
        weights = merged[at]
        packages = weights[0 : len(weights) // 2 * 2 : 2] + weights[1 : len(weights) // 2 * 2 : 2]
    take = 2 * n - 2
    for at in reversed(rounds):
        first = at[:take]
        chosen = int((first < n).sum())
        # Single ids come in order, so those among the first entries are the rarest.
        lengths[order[:chosen]] += 1
        take = 2 * (len(first) - chosen)
    return lengths


@dataclass
class Code:
    """A canonical code from its lengths."""

    lengths: np.ndarray

    def __post_init__(self) -> None:
        used = np.flatnonzero(self.lengths)
        self.order = used[np.lexsort((used, self.lengths[used]))]
        length = self.lengths[self.order].astype(np.int64)
        self.longest = int(length.max(initial=1))
        # Words of one length follow each other; a longer one begins behind them, shifted.
        steps = 1 << (self.longest - length)
        begin = np.concatenate([[0], np.cumsum(steps)])[:-1] if len(length) else np.empty(0, np.int64)
        self.words = np.zeros(len(self.lengths), np.uint64)
        self.words[self.order] = (begin >> (self.longest - length)).astype(np.uint64)
        self.table = np.zeros(1 << self.longest, np.uint32)
        spread = np.repeat(self.order, steps)
        self.table[: len(spread)] = spread

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits in 64-bit words, first bit highest, and the bit offset of every ``EVERY``-th id."""
        total = int(np.bincount(ids, minlength=len(self.lengths)) @ self.lengths.astype(np.int64))
        out, done, checkpoints = np.zeros(total // 64 + 2, np.uint64), 0, []
        for at in range(0, len(ids), STRETCH):
            some = ids[at : at + STRETCH]
            length = self.lengths[some].astype(np.int64)
            begin = np.cumsum(length) - length + done
            done = int(begin[-1] + length[-1])
            word, room = begin >> 6, 64 - (begin & 63) - length
            value = self.words[some]
            # A word of bits that overruns is cut in two.
            part = value << np.maximum(room, 0).astype(np.uint64)
            over = np.flatnonzero(room < 0)
            part[over] = value[over] >> (-room[over]).astype(np.uint64)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[first]] |= np.bitwise_or.reduceat(part, first)
            out[word[over] + 1] |= value[over] << (64 + room[over]).astype(np.uint64)
            checkpoints.append(begin[::EVERY])
        return out, np.concatenate([np.empty(0, np.int64), *checkpoints]).astype(np.uint64)

    def decode(self, bits: np.ndarray, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """All ids of a block: one id of every stretch per step."""
        out = np.zeros((len(checkpoints), EVERY), np.uint32)
        at = checkpoints.astype(np.int64)
        down = np.uint64(64 - self.longest)
        for step in range(min(EVERY, n)):
            if step and (len(checkpoints) - 1) * EVERY + step == n:
                # The last stretch ends here.
                at = at[:-1]
            word, off = at >> 6, (at & 63).astype(np.uint64)
            # Two shifts, since one by 64 is not defined.
            peek = (bits[word] << off) | ((bits[word + 1] >> np.uint64(1)) >> (np.uint64(63) - off))
            found = self.table[peek >> down]
            out[: len(at), step] = found
            at = at + self.lengths[found]
        return out.ravel()[:n]


def shared_exists(folder: str, name: str) -> bool:
    if urlparse(folder).scheme in ("", "file"):
        return os.path.exists(f"{urlparse(folder).path}/{name}")
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    return system.get_file_info(f"{path}/{name}").type == fs.FileType.File


def shared_delete(folder: str, name: str) -> None:
    """Delete a file that may be gone already."""
    if not shared_exists(folder, name):
        return
    if urlparse(folder).scheme in ("", "file"):
        try:
            os.remove(f"{urlparse(folder).path}/{name}")
        except FileNotFoundError:
            pass
        return
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    system.delete_file(f"{path}/{name}")


def raw_block(folder: str, part: int, seq: int, kind: str) -> Block:
    """The ids of a block as they were written first."""
    words = shared_read(f"{folder}/raw", block_name(part, seq))
    doc_ids, sizes, (_, _, n, _, before, more), body = parsed(words)
    ids = zstandard.ZstdDecompressor().decompress(np.asarray(body).tobytes(), allow_extra_data=True)
    return Block(doc_ids, sizes.tolist(), np.frombuffer(ids, kind)[:n], before, bool(more))


def parsed(words: np.ndarray) -> tuple[list, np.ndarray, list[int], np.ndarray]:
    """Document ids, sizes, header and what follows the index."""
    header = [int(x) for x in words[:HEADER]]
    if header[0] != MAGIC:
        raise ValueError("not a block of token ids")
    docs, at, index = header[1], HEADER, []
    for _ in range(3):
        index.append(words[at : at + docs])
        at += docs
    doc_ids = [None if null else d for d, null in zip(index[0].view(np.int64).tolist(), index[1].tolist())]
    return doc_ids, index[2].astype(np.int64), header, words[at:]


def write_blocks(folder: str, lengths: bytes, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One file per block: header, document ids, whether they are null, sizes, checkpoints, bits.

    The raw ids of a block go once its file is there; a repeated attempt finds
    the file and takes the row from it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(np.frombuffer(lengths, np.uint8))
        for batch in batches:
            rows = []
            for part, seq in zip(batch.column("part").to_pylist(), batch.column("seq").to_pylist()):
                name = block_name(part, seq)
                if not shared_exists(folder, name):
                    block = raw_block(folder, part, seq, kind)
                    bits, checkpoints = code.encode(block.ids)
                    shared_write(folder, name, [block.header(len(bits)), *block.index(), checkpoints, bits])
                shared_delete(f"{folder}/raw", name)
                _, docs, n, size = (int(x) for x in shared_read(folder, name)[:4])
                rows.append({"part": part, "seq": seq, "docs": docs, "ids": n, "bits": size * 64})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([(n, pa.int64()) for n in ("part", "seq", "docs", "ids", "bits")]))

    return run


def read_block(folder: str, part: int, seq: int, code: Code) -> Block:
    """All ids of one file."""
    doc_ids, sizes, (_, _, n, size, before, more), rest = parsed(shared_read(folder, block_name(part, seq)))
    stretches = -(-n // EVERY)
    ids = code.decode(np.asarray(rest[stretches : stretches + size]), rest[:stretches], n)
    return Block(doc_ids, sizes.tolist(), ids, before, bool(more))


READ = "doc_id long, start long, n_tokens long, ids_crc32 long, at long, whole boolean"


def read_blocks(folder: str, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every document of the files listed, or what a file has of it, with the checksum of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(shared_read(folder, "code", np.uint8)[:size])
        for batch in batches:
            for part, seq, start in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "start"))):
                block = read_block(folder, part, seq, code)
                sizes = np.array(block.sizes, np.int64)
                ends = np.cumsum(sizes)
                body = memoryview(np.ascontiguousarray(block.ids, "<u4")).cast("B")
                crc = [zlib.crc32(body[4 * (e - s) : 4 * e]) for e, s in zip(ends.tolist(), sizes.tolist())]
                at = start + ends - sizes
                begin, whole = at.copy(), np.ones(len(sizes), bool)
                begin[0] -= block.before
                whole[0] &= not block.before
                whole[-1] &= not block.more
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.doc_ids, pa.int64()), pa.array(begin), pa.array(sizes), pa.array(crc, pa.int64()), pa.array(at), pa.array(whole)],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "at", "whole"],
                )

    return run


# The polynomial of crc32, lowest power in the highest bit; in that order 1 is the highest bit, and x ** 8 is:
CRC_POLYNOMIAL, CRC_ONE, CRC_BYTE = 0xEDB88320, 1 << 31, 1 << 23


def crc_times(a: int, b: int) -> int:
    """Product of two remainders."""
    out = 0
    while a:
        if a & CRC_ONE:
            out ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (CRC_POLYNOMIAL if b & 1 else 0)
    return out


def crc_joined(first: int, second: int, size: int) -> int:
    """crc32 of two byte strings one after the other, from their checksums and the second one's size."""
    shift, power = CRC_ONE, CRC_BYTE
    while size:
        if size & 1:
            shift = crc_times(shift, power)
        power, size = crc_times(power, power), size >> 1
    return crc_times(shift, first) ^ second


def join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = []
        for pieces_ in batch.column("pieces").to_pylist():
            joined = 0
            for piece in pieces_:
                joined = crc_joined(joined, piece["crc"], 4 * piece["n"])
            crc.append(joined)
        kept = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


@dataclass
class TokenFiles:
    """Files of token ids: their folder, a row per block in order (part, seq, docs, ids, bits, start), and the code's size."""

    folder: str
    blocks: DataFrame
    size: int


def dealt(blocks: DataFrame) -> DataFrame:
    """Rows that stand for files are dealt out by number, a few files a task; files are larger than their rows."""
    return blocks.repartition(pieces(blocks.count(), TASK_BLOCKS), "part", "seq")


def write_token_files(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None, per_block: int = BLOCK_IDS) -> TokenFiles:
    """Tokenise every text, append the end id, and write all ids by ascending document id."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-files")
    with open(tokenizer or tokenizer_file(), encoding="utf-8") as f:
        definition = f.read()
    encoder = Encoder(definition)
    kind, size = encoder.kind, encoder.tokenizer.get_vocab_size()
    given = docs.select(col("doc_id").cast("long"), "text")
    chars = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    order = [col("doc_id").asc_nulls_last(), F.xxhash64("text").asc()]
    ranged = given.repartitionByRange(pieces(chars, RANGE_BYTES), *order).sortWithinPartitions(*order)
    listed = stored(ranged.mapInArrow(tokenised(definition, per_block, folder), BLOCKS), "token-blocks")
    met = listed.filter("seq < 0").select("id", "n").mapInArrow(summed(size), "id int, n long")
    counts = np.zeros(size, np.int64)
    # One row per id of the vocabulary.
    for row in met.groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts, LIMIT)
    padded = np.zeros(-(-size // 8) * 8, np.uint8)
    padded[:size] = lengths
    shared_write(folder, "code", [padded])
    blocks = dealt(listed.filter("seq >= 0").select("part", "seq"))
    written = stored(blocks.mapInArrow(write_blocks(folder, lengths.tobytes(), kind), "part long, seq long, docs long, ids long, bits long"), "token-list")
    # Two steps: blocks of a part, then one row per part.
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = written.groupBy("part").agg(F.sum("ids").alias("_all"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_offset"))
    started = written.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0))).join(offsets, "part")
    started = started.withColumn("start", col("start") + col("_offset")).drop("_offset")
    return TokenFiles(folder, stored(started, "token-starts"), size)


def read_token_files(files: TokenFiles) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    listed = dealt(files.blocks.select("part", "seq", "start"))
    read = stored(listed.mapInArrow(read_blocks(files.folder, files.size), READ), "token-read")
    result = "doc_id", "start", "n_tokens", "ids_crc32"
    # A document longer than a block is in several: as many pieces as blocks, joined in order.
    piece = F.struct("at", col("n_tokens").alias("n"), col("ids_crc32").alias("crc"))
    split = read.filter("not whole").groupBy("doc_id", "start").agg(F.sum("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(piece)).alias("pieces"))
    joined = split.mapInArrow(join_pieces, "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read.filter("whole").select(*result).unionByName(joined)


def op3_token_files(docs: DataFrame) -> DataFrame:
    return read_token_files(write_token_files(docs))
