import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from millrace.llm import token_ids
from millrace.llm.best_fit_packing import RoomTree, best_fit, pack_best_fit, read_matrix, write_matrices
from millrace.llm.squares_packing import Piece, SquaresPacker, pack_squares
from millrace.llm.token_ids import encoder


@pytest.fixture(scope="module")
def special_ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def plain_ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


HARD = ["", " ", "a  b", "x \n y", "don't  stop.\nIt's", "\ta b ", "é, è. ü.", "a b.\n\n c", "日本 語. ok", "x" * 3000, "<|endoftext|> x", "\x1c a \x85b​", "😀" * 50]


def test_ids_are_those_of_the_tokenizer(documents, plain_ids):
    for text in HARD + [r.text for r in documents.select("text").collect()]:
        assert encoder().encode(text).tolist() == plain_ids(text)


END = "<|endoftext|>"


@pytest.mark.parametrize("text", [END, END * 3, f"{END} x", f"x {END}", f"a {END} b", f"a  {END}\n{END}  b", f"<|{END}|>", "<|endoftext|", f"😀{END}é", f" {END} "])
def test_names_of_special_tokens(text, special_ids, plain_ids):
    assert encoder(special=True).encode(text).tolist() == special_ids(text)
    assert encoder().encode(text).tolist() == plain_ids(text)


def test_packed_ids_are_those_of_the_tokenizer(spark, special_ids):
    texts = [f"a {END} b", END, f"{END}{END}tail", "plain", None, "word " * 3000 + END]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = {}
    for r in pack_squares(docs, with_ids=True).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    assert {k: [i for _, ids in sorted(p) for i in ids] for k, p in pieces.items()} == {k: [*special_ids(t), 0] for k, t in enumerate(texts)}


@pytest.mark.parametrize("text", ["a " + " " * 1_100_000 + "b", "a" + "\n" * 1_100_000, "\u3000" * 1_050_000 + "<|endoftext|> b " + "\t" * 1_050_000 + "\x1c"])
def test_long_runs_of_white_space(text, plain_ids):
    assert encoder().encode(text, 7).tolist() == plain_ids(text) + [7]


def test_runs_are_cut_where_the_pattern_cuts(monkeypatch, plain_ids):
    rng = random.Random(3)
    monkeypatch.setattr(token_ids, "LONGEST_RUN", 2)
    for _ in range(3000):
        text = "".join(rng.choice("  \n\t\r\x0b\x1c\x85\xa0\u2003\u2028\u3000\u200bab1.,'") for _ in range(rng.randint(1, 30)))
        assert encoder().encode(text).tolist() == plain_ids(text)


def test_squares_packing_of_documents(documents, odd_documents, no_documents, plain_ids):
    for docs in (documents, odd_documents):
        want = {}
        for r in docs.collect():
            want.setdefault(r.doc_id, []).append(plain_ids(r.text) + [0])
        rows = pack_squares(docs, with_ids=True).collect()
        told = {}
        for r in rows:
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert len(ids) == r.length > 0 and zlib.crc32(r.ids) == r.ids_crc32
            told.setdefault(r.doc_id, []).append((r.start, ids, r.doc_tokens))
        assert set(told) == set(want)
        for key, texts in want.items():
            # Every id once: the pieces' ids are those of the texts, by place.
            have = sorted((start + i, token, n) for start, ids, n in told[key] for i, token in enumerate(ids))
            assert have == sorted((i, token, len(ids)) for ids in texts for i, token in enumerate(ids))
        windows = {}
        for r in rows:
            windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
        fills = []
        for pieces in windows.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            fills.append(at)
        assert max(fills) <= 1024 and sum(f < 1024 for f in fills) <= docs.rdd.getNumPartitions()
    assert pack_squares(no_documents).count() == 0


def test_level_minimises_the_sum_of_squares():
    rng = random.Random(5)
    packer = SquaresPacker(64)
    for _ in range(400):
        size = rng.randint(1, 63)
        before = packer.levels.copy()
        costs = {}
        for level in [0, *np.flatnonzero(before).tolist()]:
            if level + size <= 64:
                after = before.copy()
                if level:
                    after[level] -= 1
                if level + size < 64:
                    after[level + size] += 1
                costs[level] = int((after[:64] ** 2).sum())
        assert costs[packer.level_for(size)] == min(costs.values())
        list(packer.add(Piece(0, 0, array("I", range(size)), size)))


@pytest.mark.parametrize("most_open", [1, 3, 1000])
def test_cutting_loses_nothing(most_open):
    rng = random.Random(most_open)
    packer, placed, texts = SquaresPacker(32, most_open), [], {}
    for key in range(300):
        texts[key] = array("I", [rng.randint(0, 9) for _ in range(rng.choice([1, 17, 17, 31, 32, 100]))])
        placed += packer.add(Piece(key, 0, texts[key], len(texts[key])))
        assert packer.n_open <= most_open
    placed += packer.finish()
    for key, ids in texts.items():
        parts = sorted((p.start, p.ids) for p, _, _ in placed if p.key == key)
        assert array("I", [i for _, part in parts for i in part]) == ids
    fills = {}
    for p, w, _ in placed:
        fills[w] = fills.get(w, 0) + len(p.ids)
    assert sum(f < 32 for f in fills.values()) <= 1


def test_room_tree_finds_the_least_room():
    rng, tree, rooms = random.Random(1), RoomTree(100), []
    for _ in range(2000):
        if rooms and rng.random() < 0.4:
            room = rooms.pop(rng.randrange(len(rooms)))
            tree.change(room, -1)
        else:
            rooms.append(rng.randint(1, 100))
            tree.change(rooms[-1], 1)
        size = rng.randint(1, 100)
        assert tree.least_from(size) == min((r for r in rooms if r >= size), default=None)


def test_best_fit_uses_the_tightest_window():
    parts = [(i, 0, array("I", [0] * n)) for i, n in enumerate([6, 5, 5, 4, 4, 3, 3])]
    assert sorted(sorted(len(p[2]) for p in w) for w in best_fit(parts, 10)) == [[3, 3, 4], [4, 6], [5, 5]]


def test_best_fit_documents(spark, documents, odd_documents, no_documents, plain_ids, tmp_path):
    for docs in (documents, odd_documents):
        want = sorted((str(r.doc_id), tuple(plain_ids(r.text) + [50256])) for r in docs.collect())
        parts = {}
        for r in pack_best_fit(docs, window=256, block_tokens=20_000).collect():
            ids = np.frombuffer(r.input_ids, "<u2").tolist()
            assert len(ids) == 256 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
            assert all(i == 50256 for i in ids[r.n_tokens:])
            assert r.position_resets == (r.cu_seqlens if r.n_tokens < 256 else r.cu_seqlens[:-1])
            for key, start, a, b in zip(r.keys, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
                parts.setdefault(key, []).append((start, ids[a:b]))
        have = []
        for key, pieces in parts.items():
            flat = sorted((start + i, token) for start, ids in pieces for i, token in enumerate(ids))
            have += [(str(key), i, t) for i, t in flat]
        assert sorted(have) == sorted((key, i, t) for key, ids in want for i, t in enumerate(ids))
    assert pack_best_fit(no_documents).count() == 0
    write_matrices(pack_best_fit(odd_documents, window=256), str(tmp_path / "m"))
    row = read_matrix(spark, str(tmp_path / "m"), window=256).first()
    assert len(row.ids) == len(row.positions) == 256 and row.positions[0] == 0


def test_ids_that_do_not_fit_are_refused(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    with pytest.raises(Exception, match="does not fit into 2 bytes"):
        pack_best_fit(docs, window=16, end_id=70_000).collect()
    row = pack_best_fit(docs, window=16, end_id=70_000, id_bytes=4).first()
    assert np.frombuffer(row.input_ids, "<u4")[-1] == 70_000
