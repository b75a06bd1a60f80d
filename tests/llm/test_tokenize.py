import base64
import random

import pytest
from pyspark.sql import Row

from difframe.llm.queries import QUERIES
from difframe.llm.tokenize import VOCABULARY_DIR, decode_bytes, decode_corpus, encode_corpus, encode_text, encoder, parts
from difframe.runtime import table

RANKS = f"{VOCABULARY_DIR}/byte_bpe_50k.tiktoken"


def _whole(text):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    import public_tokenizers

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text)


def test_round_trip_and_second_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{VOCABULARY_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    got = {r.doc_id: r.ids for r in QUERIES["p6_ids"](spark, sf).collect()}
    assert got.keys() == texts.keys()
    enc = encoder(RANKS)
    for i, text in texts.items():
        assert decode_bytes(got[i], enc) == (text or "").encode()
        assert got[i] == (t.encode(text, add_special_tokens=False).ids if text else [])


def test_safe_boundaries_change_nothing():
    rnd = random.Random(5)
    pieces = ["word", " word", "'s", "'ll", "  ", "\n", "\n\n", " 12", "é", " ß", "語", " ", " ", "...", " -", "<|endoftext|>", "\t", "\r\n", "🙂", "a" * 30]
    enc = encoder(RANKS)
    for _ in range(60):
        text = "".join(rnd.choices(pieces, k=300))
        assert "".join(parts(text, 40)) == text
        assert encode_text(text, enc, 40) == _whole(text)


def test_edge_cases(spark):
    texts = [None, "", "   ", "\n", "<|endoftext|>", "a" * 300_000, "x y\n" * 100_000, "🙂" * 1000, "语言" * 50_000]
    df = spark.createDataFrame([Row(doc_id=i, text=t, ids="clash", lang=1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, lang int")
    df = df.union(df.where("doc_id = 2")).union(spark.createDataFrame([(None, "hi", "c", 1)], df.schema))
    rows = [(r.doc_id, r.ids) for r in encode_corpus(df).collect()]
    assert len(rows) == len(texts) + 2 and sorted(i for i, _ in rows if i is not None).count(2) == 2
    ids = dict(rows)
    enc = encoder(RANKS)
    assert ids[0] == [] and ids[1] == [] and ids[2] == _whole("   ") and ids[4] == _whole("<|endoftext|>") and 50256 not in ids[4]
    for i, t in enumerate(texts):
        assert decode_bytes(ids[i], enc) == (t or "").encode()
    assert encode_corpus(df.limit(0)).count() == 0


LONG = {
    "russian": "Порошок нагревают до семисот кельвинов, затем охлаждают; линии 14 и 27 исчезают. ",
    "chinese": "粉末在七百开尔文下加热然后冷却，第十四条线消失；探测器计数三百二十四个光子。",
    "unmarked": "粉末在七百开尔文下加热然后冷却第十四条线消失探测器计数三百二十四个光子",
    "japanese": "粉末を七百ケルビンまで加熱すると、第十四線が消えます。「結晶」は、",
    "mixed": "it's we'll 'tis don't  \t\n  x=1_000;y''s''t 'S\x1c\x85 ٣٤٥ ½² é\u0301 😀's \u2019s  ",
}


@pytest.mark.parametrize("name", LONG)
def test_long_texts_in_any_script(name):
    """A million characters come in many parts and have the ids of the uncut text."""
    enc = encoder(RANKS)
    size = 1_000_000 if name in ("russian", "chinese") else 60_000
    text = LONG[name] * (size // len(LONG[name]))
    for part_size in (50_000, 997) if size > 60_000 else (50_000, 97, 1):
        text_ = text if part_size > 1 else text[:3000]
        cut = list(parts(text_, part_size, RANKS))
        assert "".join(cut) == text_ and len(cut) >= len(text_) // (2 * part_size + 50)
        assert [i for x in cut for i in enc.encode_ordinary(x)] == enc.encode_ordinary(text_)


def test_random_characters_are_cut_safely():
    enc = encoder(RANKS)
    rnd = random.Random(3)
    pools = ["abcXYZ", " \t\n\r\u00a0\u2003\x1c", "'.,;-_/\u2019", "0123٣½", "éñßøçаяжЖ", "結晶線粉末ケルビン한국어", "\u0301\u093f\u20dd", "😀𝒳𠀀\U00031350"]
    for _ in range(300):
        text = "".join(rnd.choice(rnd.choice(pools)) for _ in range(400)) + "'ll " * 3
        cut = list(parts(text, rnd.choice((1, 3, 17)), RANKS))
        assert "".join(cut) == text and [i for x in cut for i in enc.encode_ordinary(x)] == enc.encode_ordinary(text)


def test_decoding(spark):
    rows = [(1, [25, 128]), (2, []), (3, None), (1, [25, 128])]
    got = [(r.doc_id, bytes(r.bytes)) for r in decode_corpus(spark.createDataFrame(rows, "doc_id long, ids array<int>")).collect()]
    want = encoder(RANKS).decode_bytes([25, 128])
    assert sorted(got) == [(1, want), (1, want), (2, b""), (3, b"")]
    assert decode_corpus(spark.createDataFrame(rows, "doc_id long, ids array<int>").limit(0)).count() == 0
