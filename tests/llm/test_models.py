"""Tokenizing and language-model scoring."""

import math
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from millrace.llm import lm_scoring, machines, transducer
from millrace.llm._words import WordHashes
from millrace.llm.queries import QUERIES, vocabulary
from sentencepiece import sentencepiece_model_pb2

PIECES = "piece_bpe_32k.model"


def test_pieces_are_those_of_the_library(spark, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))
    frame = spark.createDataFrame(rows + [(-1, "▁a▁▁b"), (-2, "  a  "), (None, "日本 語\t\x00")], "doc_id long, text string")
    encoded = transducer.encode(frame, vocabulary(PIECES))
    texts = dict(rows) | {-1: "▁a▁▁b", -2: "  a  ", None: "日本 語\t\x00"}
    out = encoded.collect()
    assert len(out) == len(texts)
    for r in out:
        assert r.ids == library.encode(texts[r.doc_id] or "")
    for r in transducer.decode(encoded, vocabulary(PIECES)).collect():
        assert r.text == library.decode(library.encode(texts[r.doc_id] or ""))


def test_additive_weights_take_the_shortest_path():
    """A unigram machine against all segmentations."""
    machine = transducer.Transducer(vocabulary(PIECES))
    machine.follow = machines.Anything()
    word = "▁andthing"

    def best(rest):
        if not rest:
            return 0.0
        return min((best(rest[n:]) - machine.scores[machine.ids[rest[:n]]] for n in range(1, len(rest) + 1) if rest[:n] in machine.ids), default=math.inf)

    ids = machine.shortest(word)
    assert "".join(machine.pieces[i] for i in ids) == word
    assert sum(-machine.scores[i] for i in ids) == pytest.approx(best(word))


def test_round_trip(spark, sf, rows):
    out = {r.doc_id: r for r in QUERIES["op10_sentencepiece"](spark, sf).collect()}
    assert len(out) == len(rows) and all(r.exact for r in out.values())
    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECES))
    for i, text in rows:
        ids = library.encode(text or "")
        assert (out[i].n_pieces, out[i].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def rewriting_table():
    """The library's own compatibility normalisation, compiled."""
    spec = sentencepiece_model_pb2.ModelProto.FromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
    return spec.normalizer_spec.precompiled_charsmap


def odd_texts(n=800):
    draw = random.Random(2)
    symbols = ["a", "b", "c", "f", "i", "1", " ", "  ", "ﬁ", "①", "Ａ", "e\u0301", "é", "<sep>", "日", "\t", "\u3000", "\u200b", "¨", "▁", "x", "Ω"]
    return ["".join(draw.choices(symbols, k=draw.randrange(30))) for _ in range(n)] + ["", "\u200b", "   ", " \u200b ", "<sep>", " <sep> "]


def same_as_library(model, folder):
    path = str(folder / "own.model")
    with open(path, "wb") as f:
        f.write(model.SerializeToString())
    library, machine = sentencepiece.SentencePieceProcessor(model_file=path), transducer.Transducer(path)
    for text in odd_texts():
        ids = library.encode(text)
        assert (own := machine.encode(text)) == ids or sorted(own) == sorted(ids), text  # the same pieces in another order weigh the same
        assert machine.decode(ids) == library.decode(ids), text


@pytest.mark.parametrize("in_bytes, squeeze, front, behind", [(True, True, True, False), (False, True, True, False), (True, False, True, False), (False, True, False, False), (True, True, True, True)])
def test_unigram_model_with_a_rewriting_table(tmp_path, in_bytes, squeeze, front, behind):
    """Scores are multiples of 1/1024, so sums are exact in any precision."""
    model, draw = sentencepiece_model_pb2.ModelProto(), random.Random(1)
    special = [("<unk>", transducer.UNKNOWN), ("<s>", transducer.CONTROL), ("</s>", transducer.CONTROL), ("<sep>", transducer.USER)]
    special += [(f"<0x{b:02X}>", transducer.BYTE) for b in range(256)] if in_bytes else []
    for text, kind in special:
        model.pieces.add(piece=text, score=0, type=kind)
    for text in sorted({"".join(draw.choices("abcfi1▁é", k=n)) for n in range(1, 5) for _ in range(60)}):
        model.pieces.add(piece=text, score=-draw.randrange(1024, 12288) / 1024, type=transducer.NORMAL)
    model.trainer_spec.model_type, model.trainer_spec.byte_fallback, model.trainer_spec.treat_whitespace_as_suffix = transducer.UNIGRAM, in_bytes, behind
    spec = model.normalizer_spec
    spec.precompiled_charsmap, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = rewriting_table(), front, squeeze, True
    same_as_library(model, tmp_path)


@pytest.mark.parametrize("table", [False, True])
def test_merge_model_with_user_symbols(tmp_path, table):
    with open(vocabulary(PIECES), "rb") as f:
        model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    model.pieces.add(piece="<sep>", score=0, type=transducer.USER)
    model.normalizer_spec.remove_extra_whitespaces = table
    model.normalizer_spec.precompiled_charsmap = rewriting_table() if table else b""
    same_as_library(model, tmp_path)


def test_a_text_that_does_not_come_back_is_not_exact(spark):
    frame = spark.createDataFrame([(1, "a▁b"), (2, "a b"), (3, None), (4, "日本 \x00")], "doc_id long, text string")
    out = transducer.round_trip(frame, vocabulary(PIECES)).collect()
    assert {r.doc_id: r.exact for r in out} == {1: False, 2: True, 3: True, 4: True}


def test_scores_are_those_of_plain_counts(spark):
    """Both models against a dictionary version, without shared slots."""
    good, bad = "the cat sat on the mat", "zz qq zz qq xx the"
    docs = [(1, good), (2, good + " the cat"), (3, bad), (4, None), (5, "unseen"), (None, good)]
    labels = [(1, 1, 0), (2, 1, 0), (3, 0, 0), (None, 1, 0), (5, None, 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = lm_scoring.train(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), size=50)
    out = {r.doc_id: r for r in lm_scoring.score(frame, model).collect()}
    known = set((good + " the cat").split())

    def tokens(t):
        return [w if w in known else "?" for w in (t or "").split()] + ["."]

    def trained(texts):
        one, two = {w: 0 for w in known | {"?", "."}}, {}
        for t in texts:
            before = "."
            for w in tokens(t):
                one[w] += 1
                two[before, w] = two.get((before, w), 0) + 1
                before = w
        return one, two

    def loss(t, m):
        one, two = m
        before, bits = ".", 0.0
        for w in tokens(t):
            alone = (one[w] + 0.5) / (sum(one.values()) + 0.5 * len(one))
            weight = 0.7 if one[before] else 0.0
            bits -= math.log2(weight * two.get((before, w), 0) / max(one[before], 1) + (1 - weight) * alone)
            before = w
        return bits / len(tokens(t))

    target, background = trained([good, good + " the cat"]), trained([t for _, t in docs])
    for i, t in docs:
        assert out[i].n_tokens == len(tokens(t))
        assert out[i].target_loss == pytest.approx(loss(t, target), rel=1e-5)
        assert out[i].background_loss == pytest.approx(loss(t, background), rel=1e-5)
    assert out[1].score < out[3].score


def test_scores_part_labelled_documents(spark):
    """On the driver's small table, documents labelled bad score higher."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    scored = lm_scoring.score(docs, lm_scoring.train(docs, labels)).join(labels, "doc_id").groupBy("quality").avg("score").collect()
    mean = {r.quality: r[1] for r in scored}
    assert mean[1] < mean[0]


def test_pairs_are_counted_exactly_and_the_vocabulary_is_whole(spark):
    """More words than 65,536 and more pairs than would go into 2^20 slots without sharing: no pair borrows another's count."""
    n = 70_000
    docs = [(k, " ".join(f"w{i}" for i in range(k, n, 100))) for k in range(100)] + [(-1, " ".join(f"w{i}" for i in range(n - 1, -1, -7)))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    model = lm_scoring.train(frame, spark.createDataFrame([(k, 1, 0) for k in range(100)], "doc_id long, quality int, toxic int"))
    out = {r.doc_id: r for r in lm_scoring.score(frame, model).collect()}
    total, symbols = n + 100, n + 2
    alone = lambda c: (c + 0.5) / (total + 0.5 * symbols)
    first, last = -math.log2(0.7 / 100 + 0.3 * alone(1)), -math.log2(0.7 + 0.3 * alone(100))
    assert out[5].target_loss == pytest.approx((first + 699 * -math.log2(0.7 + 0.3 * alone(1)) + last) / 701, rel=1e-9)
    assert out[-1].target_loss == pytest.approx((10_000 * -math.log2(0.3 * alone(1)) - math.log2(0.3 * alone(100))) / 10_001, rel=1e-9)
    other = spark.createDataFrame([(7, "w0 w100 nowhere w3"), (8, None)], "doc_id long, text string")
    seen = {r.doc_id: r for r in lm_scoring.score(other, model).collect()}
    bits = [first, -math.log2(0.7 + 0.3 * alone(1)), -math.log2(0.3 * alone(0)), -math.log2(alone(1)), -math.log2(0.3 * alone(100))]
    assert seen[7].target_loss == pytest.approx(sum(bits) / 5, rel=1e-9) and seen[8].n_tokens == 1


def test_texts_that_go_on_in_other_blocks_score_alike(spark, rows, monkeypatch):
    """Blocks of a few tokens, more shards than keys, and texts parted in slices change no score."""
    docs = [(i, t) for i, t in rows if t is None or len(t) < 4000] + [(rows[0][0], "a text with an id that is not its own")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, k % 3, 0) for k, (i, _) in enumerate(docs)], "doc_id long, quality int, toxic int")

    def scores(size=None):
        out = lm_scoring.score(frame, lm_scoring.train(frame, labels, size=size))
        return sorted((r.doc_id, r.n_tokens, round(r.target_loss, 9), round(r.background_loss, 9)) for r in out.collect())

    whole, small = scores(), scores(100)
    assert len(whole) == len(docs) and whole != small
    monkeypatch.setattr(lm_scoring, "BLOCK", 37)
    monkeypatch.setattr(lm_scoring, "SHARD", 11)
    assert scores() == whole and scores(100) == small


def test_slices_part_a_text_into_the_same_words(monkeypatch):
    text = b"  one two\x0bthree " + b"x" * 40 + b"\n four \t"
    whole = np.concatenate(list(lm_scoring.tokens(text, WordHashes())))
    monkeypatch.setattr(lm_scoring, "SLICE", 3)
    assert np.concatenate(list(lm_scoring.tokens(text, WordHashes()))).tolist() == whole.tolist() and len(whole) == 6
