import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from faultloom.llm import common, packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(docs, pieces):
    """Every id in exactly one piece, sequences gapless and a power of two long; ids as the tokenizer gives them."""
    tokenizer = Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for p in sorted(by_doc.pop(doc_id), key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    assert not by_doc
    for found in by_sequence.values():
        at = 0
        for p in sorted(found, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096 and at & (at - 1) == 0
        assert len({p.step_group for p in found}) == 1


def test_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], packing.pack(docs, PATH).collect())


@pytest.mark.parametrize("pool", [1, 300, 10_000])
def test_edges(spark, pool):
    texts = [None, "", " \n", "<|endoftext|> it's 42 ÉÑ ﬁ é İ Σ", "word " * 9000, "a b\x1cc d", "ß" * 50]
    docs = [(i, t) for i, t in enumerate(texts * 3)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, start string")
    check(docs, packing.pack(df, PATH, pool_tokens=pool).collect())
    assert packing.pack(df.limit(0), PATH).count() == 0
    again = df.select("doc_id", "text").union(spark.createDataFrame([(None, "a b")], "doc_id long, text string"))
    assert packing.pack(again, PATH).filter("doc_id IS NULL").selectExpr("sum(length)").first()[0] == 3


def test_tiers_and_steps():
    packer = packing.Packer(0, (64, 32, 16), 64)
    for n in (40, 10, 30, 9, 5, 64, 3, 12, 20, 31, 8):
        packer.add(n, bytes(4 * n))
    packer.end()
    rows = packer.take().to_pylist()
    assert sum(r["length"] for r in rows) == 232
    assert max(r["length"] for r in rows if r["tier"] == 64) == 64
    # The long window's gap is filled by the shorter documents that fit it best.
    long = [r for r in rows if r["doc_id"] == 40 and r["tier"] == 64][0]["sequence_id"]
    assert [r["doc_id"] for r in rows if r["sequence_id"] == long][:2] == [40, 20]
    with pytest.raises(ValueError):
        packing.pack(None, PATH, tiers=(100, 10))


def test_workers_keep_the_things_of_one_owner():
    common.forget()
    first = common.kept("one", dict)
    first["word"] = b"ids"
    assert common.kept("one", dict) is first
    other = common.kept("two", dict)
    assert other is not first and common.kept("one", dict) == {}
    common.forget()
    assert common.kept("two", dict) is not other
    common.forget()


def test_word_tables_stay_small_and_words_keep_their_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    ids, plain = packing.WordIds(path), Tokenizer.from_file(path)
    odd = ["straße", "Ñandú's", "don't", "ÿaé", "café", "İstanbul", "x1y2", "<|endoftext|>", "naïve-ish!", "µm", "ΣΑΣ"]
    for word in odd + [f"{a}é{b}" for a in ("co", "Ba") for b in ("r", "ß", "")]:
        raw = np.array(plain.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        assert ids[word.encode()] == raw, word
    letters = "abcdefghijklmnopqrst"
    for n in range(700_000):
        word = "".join(letters[n // 20**k % 20] for k in range(5)).encode()
        _ = ids[word + b"."]
    tables = (ids, ids.old, ids.stems, ids.old_stems)
    assert sum(sum(map(len, t.items())) + len(t) * 130 for t in tables) < 100e6


def test_words_come_apart_where_the_tokenizer_parts_them():
    ids, plain, draw = packing.WordIds(PATH), Tokenizer.from_file(PATH), random.Random(5)
    signs = (
        *"aszSTHAEJWY'',.!<|>_-=(19éÉÈ×÷ßµÿØσΣжЖ",
        *"²½ª\u0149\u017f\u0138\u01c5文ﬁ—“’ \n\t\x00\x1c\x7f\x85\xa0\u3000",
        *"\u02bc\u0130\u212a\u212b\u1e96\u200d",  # letters whose case or composition is odd
        *"\u0338\u0331\u0301\u0307\u0308\u030a\u030c\u0344\u0345",  # combining marks
        "'s", "'re", "'ll", "don't", "the", "The,", "ing!!", "<|endoftext|>", "<|EndOfText|>", "...", "3.14",
    )
    every = [f"x{chr(c)}{mark}y{chr(c)}{mark}{chr(c)}" for c in range(0x80, 0x500) for mark in ("!", "'s", "_")]
    for t, words in zip(every, packing.all_words([t.encode() for t in every]), strict=True):
        raw = np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert b"".join(map(ids.__getitem__, words)) == raw, t
    few = [s for s in signs if not any(0x300 <= ord(c) < 0x380 for c in s) and "<|" not in s]
    for rounds in range(300):
        texts = ["".join(draw.choices(few if rounds % 2 else signs, k=draw.randint(0, 30))) for _ in range(40)]
        found = list(packing.all_words([t.encode() for t in texts]))
        for t, words in zip(texts, found, strict=True):
            raw = np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            assert b"".join(map(ids.__getitem__, words)) == raw, t


def test_a_word_is_looked_up_whatever_its_case_and_marks():
    ids, made = packing.WordIds(PATH), []
    ids._encode = lambda word, encode=ids._encode: made.append(word) or encode(word)
    stems = "alpha", "beta", "café", "слово"
    before, behind = ("", "(", "--"), ("", ",", ".)", "?!", "-x")
    spelt = [w for s in stems for w in (s, s.capitalize() if s.isascii() else s)]
    texts = [f"{a}{w}{b}".encode() for w in spelt for a in before for b in behind]
    for words in packing.all_words(texts):
        _ = [ids[w] for w in words]
    # Four stems, one of them behind two marks too, six marks and a letter.
    assert len(set(made)) == len(made) <= 13, made
