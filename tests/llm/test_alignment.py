"""Alignment of two tokenizers against a plain one, byte by byte."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from test_operators import SCHEMA, odd_texts, sentence
from tokenizers import Tokenizer

from ledgerlens.llm import alignment, sentence_pieces, token_files


@pytest.fixture(scope="module")
def both():
    first = Tokenizer.from_file(token_files.tokenizer_file())
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.model_file())


def tokens(both, text):
    letters = alignment.byte_of_letter()
    ids_a = both[0].encode(" " + text, add_special_tokens=False).ids
    ids_b = both[1].encode(text)
    of_a = [bytes(letters[c] for c in both[0].id_to_token(i)) for i in ids_a]
    names = [both[1].id_to_piece(i) for i in ids_b]
    of_b = [bytes([int(p[3:5], 16)]) if both[1].is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, names)]
    return ids_a, of_a, ids_b, of_b


def owners(parts):
    return [i for i, p in enumerate(parts) for _ in p]


def plain(both, rows):
    made = []
    for doc_id, text in rows:
        links, groups = [], []
        if text:
            ids_a, of_a, ids_b, of_b = tokens(both, text)
            if b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
                links = [(ids_a[i], ids_b[j]) for i, j in sorted(set(zip(owners(of_a), owners(of_b))))]
                ends_a, ends_b = ({sum(map(len, p[: i + 1])): i + 1 for i in range(len(p))} for p in (of_a, of_b))
                done = (0, 0)
                for end in sorted(set(ends_a) & set(ends_b)):
                    groups.append((ids_a[done[0] : ends_a[end]], ids_b[done[1] : ends_b[end]]))
                    done = ends_a[end], ends_b[end]
        made.append((doc_id, links, groups))
    count = Counter(p for _, links, _ in made for p in set(links))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for doc_id, links, groups in made:
        shown = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(shown.encode()).hexdigest() if links else ""))
    return sorted(out, key=str), count


def rows():
    rng = random.Random(5)
    texts = [(i, t if t is None else t[:3000]) for i, t in odd_texts()]
    texts += [(30, "a ▁ mark"), (31, "<|endoftext|> and </s> <0x41>"), (32, "日本語 🙂 é\x00"), (33, " " * 40 + "x  y\n\n  z"), (34, "#" * 90 + "=" * 70)]
    texts += [(40 + i, "a text that is found very often") for i in range(300)] + [(None, "a text that is found very often")] * 3
    return texts + [(400 + i, sentence(rng, rng.randrange(40))) for i in range(60)]


def found(df):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in df.select(columns).collect()), key=str)


def test_query(spark, both):
    given = rows()
    df = spark.createDataFrame([(i, t, "en", "s", 0, 1, 0.5, 7, "t", 1) for i, t in given], SCHEMA)
    # Columns of the operator's own names don't matter.
    df = df.withColumnsRenamed({"tid": "key", "part": "n", "size": "n_a"})
    want, count = plain(both, given)
    assert found(alignment.op12_alignment(df)) == want
    made = alignment.align(df, full=True)
    assert {(r.a, r.b): r.n for r in made.pairs.collect()} == count
    for row in made.texts.collect():
        assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256 or row.groups == row.groups_sha256 == ""
    assert alignment.op12_alignment(df.limit(0)).count() == 0
    assert found(alignment.op12_alignment(df.filter("text is null"))) == [(0, 0, 0, 0, 0, 0, 0, "")]


def test_long_texts_in_parts(both, monkeypatch):
    with open(token_files.tokenizer_file(), encoding="utf-8") as f:
        definition = f.read()
    aligner = alignment.Aligner(definition, sentence_pieces.read_model())
    rng = random.Random(6)
    texts = [sentence(rng, 400) + "  \n  \n x " + sentence(rng, 200), "y" * 900, " lead " * 90, sentence(rng, 50) + " ▁ " + sentence(rng, 50)]
    whole = aligner(texts)
    monkeypatch.setattr(token_files, "PART", 60)
    parts = aligner(texts)
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        assert getattr(whole, name).tolist() == getattr(parts, name).tolist()
    assert len(aligner.parts(texts[0])) > 20 and whole.n_a[3] == 0
    for name in ("pairs", "times", "groups"):
        assert [list(x) for x in getattr(whole, name)] == [list(x) for x in getattr(parts, name)]


def test_tally():
    rng, tally, want = random.Random(7), alignment.Tally(), Counter()
    import numpy as np

    for _ in range(30):
        some = [rng.randrange(50) for _ in range(200)]
        want.update(some)
        tally.add(np.array(some), np.ones(200, np.int64))
    assert {int(a): int(b) for pairs, counts in tally.taken() for a, b in zip(pairs, counts)} == want
    assert list(alignment.Tally().taken()) == []
