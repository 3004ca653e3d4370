"""Token counts and byte-level BPE against the tokenizer libraries."""

import base64
import hashlib
import random

import public_tokenizers
import tiktoken
from cases import documents, odd_documents, results
from hypothesis import given, settings
from hypothesis import strategies as st
from peerbench.llm.byte_bpe import RANKS, Codec, encode_digests, encode_documents, merge_long, merge_short, read_ranks
from peerbench.llm.pretokens import BLOCK, Splitter
from peerbench.llm.token_counts import VOCABULARY, Counter, count_tokens
from tokenizers import Tokenizer

PATH = public_tokenizers.path(RANKS)
CODEC = Codec(PATH)
COUNTER = Counter(public_tokenizers.path(VOCABULARY))
TIKTOKEN = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={}
)
TOKENIZER = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
PARTS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", " ", "  ", "\n", "\t", "　", "a", "B", "é", "1", "²"]
PARTS += ["!", "#", "<|endoftext|>", "x" * 30, "́", "日本", "😀", "\x1c", "\x85", "​", "\r\n"]


def counted(texts):
    return [len(x.ids) for x in TOKENIZER.encode_batch(texts, add_special_tokens=False)]


def check(texts):
    cut = list(CODEC.encode(texts))
    encoded = [ids for _, ids, _ in cut]
    assert encoded == [TIKTOKEN.encode_ordinary(t) for t in texts]
    assert [CODEC.decode(ids, starts) for _, ids, starts in cut] == [t.encode() for t in texts]
    assert COUNTER.count(texts) == counted(texts)


def test_random_mixtures():
    random_ = random.Random(1)
    check(["".join(random_.choices(PARTS, k=random_.randint(0, 15))) for _ in range(5000)])


def test_long_pieces():
    random_ = random.Random(2)
    check(["a" * 5000, "ab" * 3000 + " " * 4000, "".join(random_.choices("abcdefgh", k=20_000)), " " * 9999 + "x"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_any_text(texts):
    check([t.encode("utf-8", "ignore").decode() for t in texts])


def test_every_code_point():
    points = [chr(i) for i in range(0, 0x110000, 7) if not 0xD800 <= i < 0xE000]
    check([f"a{x}b 1{x}2 .{x}! {x} {x}{x}'s" for x in points])


def test_pieces_over_block_borders():
    for size in (BLOCK - 2, BLOCK - 1, BLOCK, BLOCK + 1):
        text = "a" * size + "'ll go  now"
        assert "".join(Splitter().pieces([text, text])[1]) == text
        check([text])


def test_both_merges_agree():
    ranks = read_ranks(PATH)
    random_ = random.Random(4)
    for _ in range(300):
        raw = bytes(random_.choices(b"aeinrst hto", k=random_.randint(1, 60)))
        parts = [raw[i : i + 1] for i in range(len(raw))]
        assert merge_short(list(parts), ranks) == merge_long(list(parts), ranks)


def test_encode_documents_odd_cases(spark):
    rows = results(encode_digests(documents(spark, clashing=True)))
    expected = []
    for doc_id, text, *_ in odd_documents():
        ids = TIKTOKEN.encode_ordinary(text or "")
        digests = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (text or "").encode())]
        expected.append((doc_id, len(ids), *digests))
    assert rows == sorted(expected, key=lambda row: [(v is None, str(v)) for v in row])


def test_offsets_lead_back_to_the_text(spark):
    docs = documents(spark, [(1, "I'll see  you, naïve 😀 x", None, None, None)])
    row = encode_documents(docs, with_offsets=True).first()
    starts = [*[o.id for o in row.offsets], len(row.ids)]
    text = "I'll see  you, naïve 😀 x"
    for offset, first, last in zip(row.offsets, starts, starts[1:]):
        assert CODEC.decode(row.ids, [first, last]).decode() == text[offset.start : offset.end]
    assert bytes(row.decoded).decode() == text


def test_count_tokens_odd_cases(spark):
    expected = []
    for doc_id, text, *_ in odd_documents():
        n = counted([text or ""])[0]
        expected.append((doc_id, len((text or "").encode()), n, n > 512))
    assert results(count_tokens(documents(spark, clashing=True))) == sorted(
        expected, key=lambda row: [(v is None, str(v)) for v in row]
    )


def test_empty_tables(spark):
    assert encode_digests(documents(spark, [])).collect() == []
    assert count_tokens(documents(spark, [])).collect() == []


def test_rank_file_is_well_formed():
    ranks = read_ranks(PATH)
    assert base64.b64encode(b"a") and len(ranks) == 50_256
