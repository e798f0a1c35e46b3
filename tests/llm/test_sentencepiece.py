import random
from itertools import product

import pyarrow as pa
import pytest
import sentencepiece as library
from sentencepiece import sentencepiece_model_pb2 as proto

from landloom.llm import sentencepiece as codec
from landloom.llm.queries import tokenizer_file

ODD = ["", " ", "  a   b ", "aaaaaaaaaaaaaaaaa", "你好世界 🙂🙂", "<s> hi </s> <unk> <0x0A>", "\t\n x\n\n", "hello    world", "x \n y",
       "\x00a\x00\x00", "            deep", "(((((((((()))))))", "=====================", "a\r\nb", "word " * 3000]


@pytest.fixture(scope="module")
def path():
    return tokenizer_file("piece_bpe_32k.model")


def samples(n=300):
    draw = random.Random(5)
    return ODD + ["".join(draw.choice("abcdefgh  \n.éñ=-_()tion") for _ in range(draw.randint(0, 80))) for _ in range(n)]


def test_ids_are_the_librarys(spark, path):
    texts = samples() + ["▁x", "a ▁ b"]
    rows = [(i, t, "z") for i, t in enumerate(texts)] + [(-1, None, None), (None, "null id", "z"), (0, "", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = codec.decode(codec.encode(df, path), path).collect()
    assert len(out) == len(rows)
    sp = library.SentencePieceProcessor(model_file=path)
    for r in out:
        assert list(r["ids"]) == sp.encode(r["text"] or "")
        assert r["decoded"] == (r["text"] or "").replace("▁", " ")


def test_empty_table(spark, path):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert codec.decode(codec.encode(df, path), path).count() == 0


def unigram(tmp_path):
    model = proto.ModelProto()
    model.trainer_spec.model_type = 1
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.add_dummy_prefix = True
    model.normalizer_spec.escape_whitespaces = True
    for piece, score, kind in [("<unk>", 0, 2), ("<s>", 0, 3), ("▁", -2.1, 1), ("a", -3.3, 1), ("b", -3.7, 1), ("ab", -4.2, 1), ("▁a", -3.9, 1),
                               ("ba", -5.1, 1), ("aba", -6.05, 1), ("▁ab", -7.3, 1), ("bb", -4.9, 1)]:
        p = model.pieces.add()
        p.piece, p.score, p.type = piece, score, kind
    file = tmp_path / "own.model"
    file.write_bytes(model.SerializeToString())
    return str(file)


def test_unigram_takes_the_best_sum(tmp_path):
    model = codec.Pieces(unigram(tmp_path))
    score = dict(zip(model.text, model.score))

    def best(word):
        if not word:
            return 0.0, []
        return max(((score[word[:k]] + best(word[k:])[0], [word[:k], *best(word[k:])[1]])
                    for k in range(1, len(word) + 1) if word[:k] in score and not word.startswith("<")), key=lambda x: x[0])
    words = ["▁" + "".join(w) for n in range(1, 8) for w in product("ab", repeat=n)]
    ids, sizes = model.encode_words(words)
    at = 0
    for w, n in zip(words, sizes):
        pieces = [model.text[i] for i in ids[at:at + n]]
        at += n
        assert "".join(pieces) == w
        assert abs(sum(score[p] for p in pieces) - best(w)[0]) < 1e-9


def test_unknown_letters_without_byte_pieces(tmp_path):
    own = codec.Encoder(codec.Pieces(unigram(tmp_path)))
    ids, cuts = own.encode(pa.array(["axxb", None]))
    assert [own.model.text[i] for i in ids] == ["▁a", "<unk>", "b"] and cuts.tolist() == [0, 3, 3]


def test_one_pass_gives_the_same(spark, path, monkeypatch):
    monkeypatch.setattr(codec, "DECODED", 50)
    texts = samples(60) + [None, "x" * 6_000, "long words " * 30_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {r.doc_id: (r.ids, r.decoded) for r in codec.decode(codec.encode(df, path), path).collect()}
    got = {r.doc_id: (r.ids, r.decoded) for r in codec.encode_and_decode(df.withColumn("decoded", df.doc_id), path).collect()}
    assert got == want
    sp = library.SentencePieceProcessor(model_file=path)
    assert all(got[i] == (sp.encode(t or ""), (t or "").replace("▁", " ")) for i, t in enumerate(texts))


def test_any_ids_decode(spark, path):
    sp = library.SentencePieceProcessor(model_file=path)
    ids = [[], [0], [1, 2], [sp.piece_to_id("<0xFF>"), 500, sp.piece_to_id("<0xC3>")], [sp.piece_to_id("▁"), sp.piece_to_id("▁the")]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)] + [(9, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in codec.decode(df, path).collect()}
    piece = sp.id_to_piece(500).replace("▁", " ")
    assert got == {0: "", 1: "⁇ ", 2: "", 3: "�" + piece + "�", 4: " the", 9: ""}
