"""Blocks of token files: bounds, long texts over several blocks, checksums of pieces."""

import random
import zlib

import numpy as np
import pyarrow as pa
from test_operators import SCHEMA, sentence

from ledgerlens.llm import token_files
from ledgerlens.llm.common import by_value

by_value(__name__)


def test_checksums_join():
    rng = random.Random(1)
    for _ in range(50):
        a, b = (rng.randbytes(rng.choice([0, 1, 7, 300, 5000])) for _ in range(2))
        assert token_files.crc_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def plain(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_files.tokenizer_file())
    out, start = [], 0
    for i, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_long_texts_keep_the_bound(spark, monkeypatch):
    rng = random.Random(2)
    # Blanks beside blanks and other white space are no places to cut.
    texts = [(i, sentence(rng, 900) + "  \n x   " + sentence(rng, 300) + rng.choice(["", " ", "\n"])) for i in range(64)]
    texts += [(64, None), (65, ""), (66, "x" * 5000), (67, sentence(rng, 9000)), (None, sentence(rng, 2000))]
    df = spark.createDataFrame([(i, t, None, None, 0, 0, 0.0, 0, "", 0) for i, t in texts], SCHEMA)
    monkeypatch.setattr(token_files, "PART", 400)
    monkeypatch.setattr(token_files, "RANGE_BYTES", 100_000)
    # A slice of one text, so that each is a long one.
    monkeypatch.setattr(token_files, "slices", lambda batch, text, limit: one_by_one(batch, text))
    files = token_files.write_token_files(df, per_block=1000)
    blocks = files.blocks.collect()
    # A part has 400 characters and what follows up to the next place to cut, but for the text without one.
    assert len(blocks) > 60 and sorted(b.ids for b in blocks)[-2] <= 1000 + 400
    found = sorted((tuple(r) for r in token_files.read_token_files(files).collect()), key=lambda r: r[1])
    assert found == plain(texts)


def test_an_attempt_that_comes_again_takes_the_row_from_the_file(spark):
    texts = [(i, f"text number {i} " * 50) for i in range(40)]
    df = spark.createDataFrame([(i, t, None, None, 0, 0, 0.0, 0, "", 0) for i, t in texts], SCHEMA)
    files = token_files.write_token_files(df, per_block=300)
    code, row = token_files.shared_read(files.folder, "code", np.uint8)[: files.size], files.blocks.orderBy("part", "seq").first()
    batch = pa.RecordBatch.from_pylist([{"part": row.part, "seq": row.seq}])
    [again] = token_files.write_blocks(files.folder, code.tobytes(), "<u2")([batch])
    assert again.to_pylist() == [{c: row[c] for c in ("part", "seq", "docs", "ids", "bits")}]
    assert not token_files.shared_exists(f"{files.folder}/raw", token_files.block_name(row.part, row.seq))
    assert sorted((tuple(r) for r in token_files.read_token_files(files).collect()), key=lambda r: r[1]) == plain(texts)


def one_by_one(batch, text):
    for i in range(batch.num_rows):
        value = batch.column(text)[i].as_py()
        yield batch.slice(i, 1), [(value or "").encode()]
