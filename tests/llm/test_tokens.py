import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from marlstone.llm import tokens
from marlstone.llm.bpe import WHITE, Bpe, Decoder, Encoder, sufficient_lookahead
from marlstone.llm.queries import op1_bpe, tokenizer_path
from tests.llm.brute import ODD_TEXTS, by_id, empty_documents, odd_documents, rows

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    path = tokenizer_path(request.param)
    with open(path, encoding="utf-8") as file:
        return Bpe(file.read()), Tokenizer.from_file(path)


def odd_texts():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz" * 3 + "ÉéßñΣσςİ0123456789 ' \n\t!?.,-_<|>\u2009\u3000日本語한국어😀🏽\u0301\u200d"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 300))) for _ in range(300)]
    made += ["".join(rng.choice("abth") for _ in range(3000)) for _ in range(3)]
    made += ["Hello world's ΣΑΣ! <|endoftext|> <|ENDOFTEXT|><|startoftext|>", " ".join("x" + c + "y" + c + c + " z " + c for c in WHITE + "\x1c\x1d\u200b\ufeff")]
    made += ["I'LL we've 'S !!'s !!!'s 's's", "  lead", "trail   ", "가각 각", "\u0301x a\u0323\u0301", "ſ K Å", "a \n b\n  c\n\n d \n"]
    return [t or "" for t in ODD_TEXTS] + made


def test_ids_and_texts_equal_the_library(both):
    bpe, library = both
    texts = odd_texts()
    wanted = library.encode_batch(texts, add_special_tokens=False)
    for text, raw, want in zip(texts, bpe.encode(texts), wanted, strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == want.ids, text[:80]
        assert tokens.decoded(bpe, want.ids) == library.decode(want.ids, skip_special_tokens=False)


def test_any_window_above_the_lookahead_gives_the_same_ids(both):
    bpe, library = both
    with open(tokenizer_path(FILES[bpe.byte_level]), encoding="utf-8") as file:
        narrow = Bpe(file.read(), window=bpe.lookahead + 300)
    rng = random.Random(5)
    texts = ["".join(rng.choice("thandsoi") for _ in range(2500)) for _ in range(2)] + ["a" * 2000]
    for raw, want in zip(narrow.encode(texts), library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == want.ids


def test_blocks_give_what_the_whole_gives(both):
    bpe, library = both
    rng = random.Random(7)
    for text in odd_texts()[:150]:
        if "<|" in text:
            continue
        encoder, found, at = Encoder(bpe), [], 0
        while at < len(text):
            step = rng.randrange(1, 30)
            found += encoder.feed(text[at : at + step]).tolist()
            at += step
        found += encoder.close().tolist()
        assert found == library.encode(text, add_special_tokens=False).ids
        decoder, out = Decoder(bpe), ""
        for i in range(0, len(found), 3):
            out += decoder.feed(found[i : i + 3])
        assert out + decoder.close() == library.decode(found, skip_special_tokens=False)


def test_lookahead_of_a_small_list():
    # b c | joins c before b could join it, which frees a: the chain is c, then b
    ids = {"a": 0, "b": 1, "c": 2, "d": 3, "cd": 4, "bc": 5, "ab": 6}
    lengths = {i: len(t) for t, i in ids.items()}
    assert sufficient_lookahead([(2, 3, 4), (1, 2, 5), (0, 1, 6)], lengths) == 3
    assert sufficient_lookahead([(0, 1, 6)], lengths) == 1


def test_forgetting_changes_nothing(both):
    bpe, library = both
    with open(tokenizer_path(FILES[bpe.byte_level]), encoding="utf-8") as file:
        small = Bpe(file.read(), remember=3)
    for text in ("one two three four five", "six seven one two", "one"):
        assert np.frombuffer(next(small.encode([text])), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def expected(texts):
    library = Tokenizer.from_file(tokenizer_path(FILES[0]))
    for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False):
        ids = hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest()
        yield len(e.ids), ids, hashlib.sha256(library.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()


def test_query_equals_the_library(spark, folder):
    out = by_id(op1_bpe(spark, folder))
    docs = rows(folder, "documents")
    assert len(out) == len(docs)
    for doc, want in zip(docs, expected([d["text"] for d in docs]), strict=True):
        got = out[doc["doc_id"]]
        assert (got["n_tokens"], got["ids_sha256"], got["decoded_sha256"]) == want


def test_odd_documents_round_trip(spark):
    path = tokenizer_path(FILES[1])
    df = odd_documents(spark)
    ids = tokens.encode(df, path, ["doc_id", "score", "text"])
    back = tokens.decode(ids, path, ["doc_id", "text"], name="again").collect()
    assert len(back) == df.count()
    assert all(r["again"] == (r["text"] or "") for r in back)
    assert tokens.round_trip(empty_documents(spark), path, ["doc_id"]).collect() == []
    assert tokens.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), path, ["doc_id"]).first()["text"] is None
