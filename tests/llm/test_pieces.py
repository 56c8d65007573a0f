"""SentencePiece encoding against the library's own encoder."""

import gc
import os
import random
import weakref

import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from larkspur.llm import pieces
from larkspur.llm.queries import PIECE_MODEL

pytestmark = pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="no tokenizer file")


@pytest.fixture(scope="module")
def own():
    return pieces.Pieces(open(PIECE_MODEL, "rb").read())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def strings():
    rng = random.Random(3)
    parts = ["a", "b", "the", " ", "  ", "\n", "é", "日", "x", "er", "tion", "▁", "\U0001f600", "1", "\r\n", ";", "=", "    ", "http://", "ing", "\u3000"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    return [*made, "", " ", *(c * k for c in (" ", "a", "ab", "=") for k in (1, 2, 3, 17, 40)), "long" * 5000]


def test_ids_are_the_librarys(own, library):
    xs = strings()
    assert pieces.encode_texts(own, pa.array(xs)).to_pylist() == library.encode(xs)
    assert pieces.encode_texts(own, pa.array([None, "a", None])).to_pylist() == [[], library.encode("a"), []]


def test_decoding(own, library):
    xs = strings()
    ids = library.encode(xs)
    assert pieces.decode_ids(own, pa.array(ids, pa.list_(pa.int32()))).to_pylist() == library.decode(ids)
    odd = pa.array([None, [], [0], [3 + 0xE9], [1, 259, 2]], pa.list_(pa.int32()))
    assert pieces.decode_ids(own, odd).to_pylist()[:2] == ["", ""] and pieces.decode_ids(own, odd).to_pylist()[3] == "\ufffd"


def test_unigram_models_take_the_best_sum(own):
    plain = pieces.Pieces(open(PIECE_MODEL, "rb").read(), kind="unigram")
    for word in ("▁theres", "▁oneing", "▁日x", "▁aaa"):
        best = {0: (0.0, [])}
        for i in range(1, len(word) + 1):
            for j in range(i):
                piece = plain.id.get(word[j:i], -1 if i - j == 1 else None)
                if piece is not None:
                    s = best[j][0] + (plain.score[piece] if piece >= 0 else plain.worst)
                    if i not in best or s > best[i][0]:
                        best[i] = (s, best[j][1] + ([piece] if piece >= 0 else list(reversed(plain._fallback(word[j])))))
        assert plain.encode_words([word]) == [best[len(word)][1]]
    with pytest.raises(ValueError):
        pieces.Pieces(open(PIECE_MODEL, "rb").read(), kind="word")


def test_frames(spark, documents, library):
    rows = [(i, x) for i, x in enumerate(strings()[:300])] + [(1, None), (None, "a  b"), (5, "again"), (5, "again")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"ids": F.lit("x"), "c0": F.lit(1)})
    encoded = pieces.encode(df, PIECE_MODEL)
    decoded = pieces.decode(encoded.withColumn("out", F.lit(2)), PIECE_MODEL)
    assert decoded.columns == ["doc_id", "text", "ids", "out", "decoded"]
    for r in decoded.collect():
        assert list(r.ids) == library.encode(r.text or "") and r.decoded == library.decode(list(r.ids))
    same = pieces.round_trip(df, PIECE_MODEL).collect()
    assert len(same) == len(rows) and [r.same for r in same] == ["▁" not in (t or "") for _, t in rows]
    assert pieces.encode(df.limit(0), PIECE_MODEL).count() == 0
    assert pieces.round_trip(documents, PIECE_MODEL).where("not same").count() == 0


def test_the_encoder_goes_with_its_broadcast():
    class Held:  # as a worker holds a broadcast until a task comes that does not use it
        value = open(PIECE_MODEL, "rb").read()

    shared = Held()
    texts = pa.RecordBatch.from_arrays([pa.array(["two words"])], ["text"])
    first, second = (next(pieces._map(shared, "bpe", "text", "ids", pieces.encode_texts)([texts])) for _ in range(2))
    assert first.equals(second)
    made = weakref.ref(pieces._pieces(shared, "bpe"))
    assert made() is pieces._pieces(shared, "bpe")  # one for all tasks
    del shared
    gc.collect()
    assert made() is None
