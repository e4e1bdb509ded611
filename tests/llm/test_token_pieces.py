"""Ids by remembered pieces are those of whole texts, and few pieces are remembered."""

import random

import numpy as np
import pytest

pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

from ledgerlens.llm import token_files
from ledgerlens.llm.token_files import ODD_BYTES, ODD_SPACE, Encoder, Known, tokenizer_file


@pytest.fixture(scope="module")
def definition():
    with open(tokenizer_file(), encoding="utf-8") as f:
        return f.read()


def ids(encode, body):
    return np.frombuffer(body, encode.kind).tolist()


def test_ids_are_those_of_whole_texts(definition):
    encode, draw = Encoder(definition), random.Random(5)
    signs = ["a", "Be", "th", "é", "ß", "7", " ", " ", "\n", "\n\n", ".", ",", "'", "'s", "n't", "&&", "-", "_", "中", "😀", "́", "\x00", "\t", "\xa0"]
    for _ in range(60):
        texts = ["".join(draw.choices(signs, k=draw.randrange(0, 40))) for _ in range(50)]
        texts += [" ".join("".join(draw.choices(signs[:6] + signs[10:19], k=4)) for _ in range(9)) + draw.choice(["", "\n", ".\n\n"]) for _ in range(50)]
        texts += ["\n".join("".join(draw.choices(signs[:18], k=4)).strip() for _ in range(9)) for _ in range(50)]
        want = [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [ids(encode, body) for body in encode(texts)] == want


def test_a_word_is_remembered_once_whatever_stands_behind_it(definition):
    encode = Encoder(definition)
    found = encode([f"a stone, stone. stone; stone! sand, sand. sand; sand!\n{end} stone" for end in ("six", "seven")])
    assert len(set(found)) == 2
    # "a", two words with a blank, two with a line feed, and four signs.
    assert len(encode.known) == 1 + 2 + 2 + 4


def test_words_of_one_range_stay_remembered(definition):
    encode, learned = Encoder(definition), []
    learn = encode.learn
    encode.learn = lambda missing: (learned.extend(missing), learn(missing))
    words = [f"{a}{b}{c}{d}" for a in "bcdfghjklm" for b in "aeiou" for c in "bcdfghjklmnpqrst" for d in ("".join((x, y, z)) for x in "aeiou" for y in "nrst" for z in "aeiou")]
    random.Random(2).shuffle(words)
    # Twice as many as there was room for when all were forgotten at 40 MB.
    words = (words * 6)[:80_000] + [f"{w}x" for w in words] + [f"{w}q" for w in words] + [f"{w}v" for w in words]
    for _ in range(2):
        for at in range(0, len(words), 20_000):
            encode([" " + " ".join(words[at : at + 20_000])])
    assert len(learned) == len(set(learned))


def test_more_words_of_one_range_stay_remembered(definition):
    encode, learned = Encoder(definition), []
    learn = encode.learn
    encode.learn = lambda missing: (learned.extend(missing), learn(missing))
    # As many as 64 MB of the check tool's documents have; before, all were forgotten after 600,000.
    words = [f"{a}{b}{c}{d}" for a in "bcdfgklmnt" for b in "aeiou" for c in (f"{x}{y}" for x in "bcdfgklmnt" for y in "aeiou") for d in (f"{x}{y}{z}" for x in "bdgklmnprst" for y in "aeiou" for z in "nrst")]
    words = [*words, *(f"{w}o" for w in words), *(f"{w}u" for w in words), *(f"{w}i" for w in words), *(f"{w}a" for w in words)][:690_000]
    random.Random(4).shuffle(words)
    for part in (words, words[:60_000]):
        for at in range(0, len(part), 30_000):
            encode([" " + " ".join(part[at : at + 30_000])])
    assert len(learned) == len(set(learned)) == len(encode.known) == len(words) > 530_000


def test_pieces_are_told_apart_whole(monkeypatch):
    # All begin at one place of the table; zero bytes at an end are not those that fill up a number.
    monkeypatch.setattr(Known, "first", lambda self, low, high: np.full(len(low), len(self.at) - 2))
    monkeypatch.setattr(token_files, "PLACES", 4)
    known, entries = Known("<u2"), {}
    stems = [b"a", b"a\0", b"a\0\0", b"abcdefg", b"abcdefgh", b"abcdefgh\0", b"abcdefghi", b"b" * 14, b"b" * 15, b"b" * 16, b"b" * 17, b"c" * 40, b"\0", b"\xff" * 15]
    for at, some in enumerate((stems[::2], stems[1::2])):
        sizes = np.array([i % 4 for i in range(len(some))])
        ids = np.arange(sizes.sum(), dtype="<u2") + 100 * at
        begin = np.cumsum(sizes) - sizes
        known.add(some, ids, begin, sizes)
        entries.update((p, ids[b : b + n].tolist()) for p, b, n in zip(some, begin, sizes))
    assert len(known) == len(stems) and sorted(known.long) == sorted(p for p in stems if len(p) > 15)
    asked = [p for p in stems if len(p) <= 15] + [b"b", b"abcdef", b"b" * 13, b"a\0\0\0"]
    length = np.array([len(p) for p in asked])
    found = known.find(*token_files.short_keys(b"".join([*asked, bytes(16)]), np.cumsum(length) - length, length)).tolist()
    assert found[-4:] == [-1] * 4
    found = dict(zip(asked, found[:-4])) | known.long
    assert {p: known.ids[at >> 32 :][: at & 0xFFFFFFFF].tolist() for p, at in found.items()} == entries


def test_ids_are_the_same_when_pieces_are_forgotten_at_once(definition, monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED_BYTES", 0)
    encode, draw = Encoder(definition), random.Random(6)
    words = ["stone", "unforgettable", "internationalisation", "straße", "中文字", "ab\0", "ab", "x" * 14, "x" * 15, "don't", "e.g.", "1,000\n"]
    for _ in range(20):
        texts = [" ".join(draw.choices(words, k=draw.randrange(1, 30))) for _ in range(20)]
        want = [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [ids(encode, body) for body in encode(texts)] == want


def test_odd_space_is_known_by_its_first_byte():
    assert {chr(i).encode()[0] for i in range(0xD800) if ODD_SPACE.match(chr(i))} <= set(ODD_BYTES)
