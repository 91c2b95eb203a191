import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from citemill.llm import queries, sentencepieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")


def with_map(tmp_path, rule, squeezed=False, prefix=True):
    """The given model with the character map of a rule of the library."""
    model = proto.ModelProto()
    with open(PATH, "rb") as file:
        model.ParseFromString(file.read())
    if rule:
        made = proto.ModelProto()
        made.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
        model.normalizer_spec.precompiled_charsmap = made.normalizer_spec.precompiled_charsmap
    model.normalizer_spec.remove_extra_whitespaces = squeezed
    model.normalizer_spec.add_dummy_prefix = prefix
    path = str(tmp_path / f"{rule}-{squeezed}-{prefix}.model")
    with open(path, "wb") as file:
        file.write(model.SerializeToString())
    return path


def texts():
    r = random.Random(3)
    bank = ["the", " ", "  ", "\n", "é", "é", "中文", "▁", "😀", "\t", "123", "ﬁ", "ａ", "<s>", "<0x0A>", " ", "​", "ung", ".", "\x00", "가", "　", "Å"]
    made = ["".join(r.choice(bank) for _ in range(r.randrange(0, 40))) for _ in range(300)]
    return [*made, None, "", " ", "   ", "a", " a", "a ", "x" * 5000, "ab" * 40_000, " " * 3000, "=" * 700, "▁", "中" * 900, "word " * 20_000]


def library(path, text):
    tool = sentencepiece.SentencePieceProcessor(model_file=path)
    found = tool.encode(text or "", return_type="proto")
    spans = [(p.begin, p.end) for p in found.pieces]
    ids = [p.id for p in found.pieces]
    return ids, spans, tool.decode(ids)


@pytest.mark.parametrize("rule, squeezed, prefix", [(None, False, True), ("nmt_nfkc", True, True), ("nfkc_cf", False, False), (None, True, True)])
def test_ids_spans_and_texts_equal_the_library(spark, tmp_path, rule, squeezed, prefix):
    path = with_map(tmp_path, rule, squeezed, prefix) if rule or squeezed else PATH
    rows = list(enumerate(texts()))
    frame = spark.createDataFrame(rows, "id long, text string").repartition(3)
    found = sp.decode(sp.encode(frame, path), path).collect()
    assert len(found) == len(rows)
    for x in found:
        ids, spans, decoded = library(path, rows[x.id][1])
        assert x.ids == ids, repr(rows[x.id][1][:80])
        assert list(zip(x.begins, x.ends)) == spans, repr(rows[x.id][1][:80])
        assert x.decoded == decoded, repr(rows[x.id][1][:80])


def test_given_texts_come_back(spark, small):
    frame = spark.read.parquet(f"{small}/documents.parquet")
    found = sp.decode(sp.encode(frame, PATH), PATH).collect()
    assert len(found) == 200
    for x in found:
        assert x.ids == library(PATH, x.text)[0] and x.decoded == x.text
        assert x.begins[0] == 0 and x.ends[-1] == len(x.text.encode())


def test_any_list_of_ids_decodes_as_the_library_does(spark):
    r = random.Random(5)
    tool = sentencepiece.SentencePieceProcessor(model_file=PATH)
    lists = [[r.choice((0, 1, 2, r.randrange(3, 259), r.randrange(259, 32000), 28705)) for _ in range(r.randrange(0, 12))] for _ in range(400)]
    frame = spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "id long, ids array<int>")
    for x in sp.decode(frame, PATH).collect():
        assert x.decoded == tool.decode(lists[x.id]), lists[x.id]
    odd = spark.createDataFrame([(None,), ([],), ([None, 264],), ([99_999],)], "ids array<int>")
    assert [x.decoded for x in sp.decode(odd, PATH).collect()] == ["", "", " ⁇  a", " ⁇ "]


def test_bytes_that_are_no_text(spark):
    frame = spark.sql("select cast(unhex('61ff20e2968162c3') as string) as text")
    x = sp.encode(frame, PATH).first()
    assert x.ids == library(PATH, "a� ▁b�")[0]
    assert x.ends[-1] == 8 and x.begins == sorted(x.begins)


def test_names_repeats_and_empty_tables(spark):
    frame = spark.createDataFrame([("hi", 1, "x")] * 2, "text string, ids long, body string")
    twice = sp.encode(frame, PATH).collect()
    assert twice[0] == twice[1] and twice[0].body == "x" and twice[0].asDict().keys() == {"text", "body", "ids", "begins", "ends"}
    assert sp.encode(frame.limit(0), PATH).isEmpty() and sp.decode(sp.encode(frame.limit(0), PATH), PATH).isEmpty()


def test_other_models_are_refused():
    with open(PATH, "rb") as file:
        model = proto.ModelProto.FromString(file.read())
    model.trainer_spec.model_type = 1
    with pytest.raises(ValueError):
        sp.Model(model.SerializeToString())


def test_query_equals_the_library(spark, small):
    tool = sentencepiece.SentencePieceProcessor(model_file=PATH)
    found = {x.doc_id: x for x in queries.op13_sentencepiece(spark, small).collect()}
    given = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(found) == len(given)
    for x in given:
        ids = tool.encode(x.text)
        made = found[x.doc_id]
        assert made.n_tokens == len(ids)
        assert made.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert made.decoded_sha256 == hashlib.sha256(tool.decode(ids).encode()).hexdigest()
