import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tunelake.llm import common, token_files
from tunelake.llm.token_files import Encoder, Shard, key_hashes, perfect_hash

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, shard string, part long"


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000, 5000])
def test_the_hash_is_perfect_and_minimal(size):
    hashes = key_hashes(np.arange(size) * 7, np.zeros(size, np.int64))
    displacement = perfect_hash(hashes)
    slots = token_files._slots(hashes, displacement[token_files._buckets(hashes, size)], size)
    assert sorted(slots.tolist()) == list(range(size))


def test_ids_equal_those_of_the_library():
    rng = random.Random(3)
    alphabet = ["a", "The", "  ", " ", "\n", "\t", "'s", "12", "é", "日本", "!", " \n ", " ", " ", "\x1f", "\x85",
                "don't", "<|endoftext|>", "x" * 40, "😀", "."]
    texts = ["", " ", "\n", "a  b", " lead", "trail ", "one two\nthree  four"] + [
        "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(1500)
    ]
    whole = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    encoder = Encoder(PATH)
    for _ in range(2):  # the second time from what is remembered
        assert [ids.tolist() for ids in encoder.encode(texts)] == whole


def test_forgetting_does_not_change_ids(monkeypatch):
    texts = [f"some words {i} and\nmore{i}" for i in range(50)]
    whole = [ids.tolist() for ids in Encoder(PATH).encode(texts)]
    monkeypatch.setattr(common, "REMEMBERED_SPANS", 25)
    encoder = Encoder(PATH)
    assert [i.tolist() for k in range(0, 50, 5) for i in encoder.encode(texts[k:k + 5])] == whole
    assert 0 < encoder.known.size <= 25


def test_plain_pieces_are_cut_as_the_library_cuts():
    rng = random.Random(5)
    atoms = ["word", "Été", "ĀšƵɏ", "42", "007", ",", "...", "?!", "\n", "a", "×", "÷", "'", "é", "-", "ß", "\u0250", "٣", "Ⅷ", "…", "。", "´", "ʰ", "ñ", "<|endoftext|>", "\n\n", "\t", "\xa0"]
    texts = [
        " ".join("".join(rng.choice(atoms) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 8)))
        for _ in range(3000)
    ]
    encoder = Encoder(PATH)
    whole = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == whole


def test_spaces_beside_other_white_space_are_no_cuts():
    spaces = ["\x85", "\xa0", "\u1680", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "\x1c", "\t", " ", "\r\n"]
    others = ["é", "\u200b", "\u2060", "\ufeff", "Ａ", "x", "\u30a0", "Â", "à", "\u0320"]
    rng = random.Random(6)
    texts = ["".join(rng.choice([*spaces, *others, " ", " "]) for _ in range(rng.randint(1, 12))) for _ in range(4000)]
    encoder = Encoder(PATH)
    whole = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert [i.tolist() for k in range(0, 4000, 500) for i in encoder.encode(texts[k:k + 500])] == whole


def test_unspaced_texts_are_not_remembered():
    texts = ["".join(chr(97 + (i * k) % 26) for i in range(5000)) for k in range(1, 20)]
    encoder = Encoder(PATH)
    whole = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == whole
    assert encoder.known.size == 0


def _expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    start, found = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def test_documents_read_back(spark, monkeypatch):
    rows = [(i * 3, f"text {i} " * (i % 9)) for i in range(300)]
    rows += [(None, "no id"), (None, None), (6, "again"), (6, "text 2 text 2 "), (9, None), (10**15, ""), (-4, "z " * 30000)]
    index = token_files.write(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5), PATH)
    got = token_files.read(index).collect()
    order = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.occurrence))
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in order] == _expected(rows)
    one = index.where("doc_id = 30").first()
    ids = Shard(one.shard).ids(30)
    assert ids.tolist() == [*Tokenizer.from_file(PATH).encode(dict(rows)[30], add_special_tokens=False).ids, 0]
    assert Shard(one.shard).ids(31) is None


def test_empty_table(spark):
    assert token_files.read(token_files.write(spark.createDataFrame([], SCHEMA), PATH)).count() == 0


def test_full_shards_are_closed(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_DOCS", 3)
    writer = token_files._Writer(str(tmp_path), 2)
    for i in range(3):
        assert not writer.full()
        writer.add(i, 0, np.arange(i + 1))
    assert writer.full()
    path, total = writer.close()
    assert total == 6 and [Shard(path).ids(i).tolist() for i in range(3)] == [[0], [0, 1], [0, 1, 2]]


def test_a_look_up_reads_a_few_bytes(tmp_path):
    writer, rng = token_files._Writer(str(tmp_path), 2), np.random.default_rng(1)
    given = {i * 7: rng.integers(0, 50_000, rng.integers(0, 300)).astype(np.uint32) for i in range(900)}
    for doc_id, ids in given.items():
        writer.add(doc_id, 0, ids)
    path, total = writer.close()
    shard = Shard(path)
    for doc_id in (0, 7, 6293, 3500):
        keyed = token_files.KeyedFile(path)
        assert keyed.ids(doc_id).tolist() == shard.ids(doc_id).tolist() == given[doc_id].tolist()
        assert keyed.bytes_read == 32 + 4 + 20 + 2 * len(given[doc_id]) < total // 10
        assert keyed.ids(doc_id + 1) is None and keyed.ids(doc_id, 1) is None and keyed.ids(None) is None
