import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from careline.llm import bpe
from careline.llm.queries import RANKS, op5_byte_bpe
from tests.conftest import SF

LETTERS = "ab the 's  \n\t.,éß中文   10 12'll\x1c\u0085<|>[]%%--==   "


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoder_equals_the_library(ranks, library):
    random.seed(7)
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    texts = ["".join(random.choices(LETTERS, k=random.randint(0, 40))) for _ in range(8000)]
    texts += ["", " ", "x" * 5000, "abcdefgh" * 3000, "<|endoftext|>", "a  b \n c"]
    assert [encoder.encode(t) for t in texts] == [library.encode_ordinary(t) for t in texts]


def test_prefix_table_holds_every_prefix(ranks):
    random.seed(8)
    v = bpe.Vocabulary(ranks)
    for _ in range(150):
        data = "".join(random.choices("aeiothnsrbledgsx 1é", k=random.randint(1, 40))).encode()
        table = bpe.PrefixTable(v, data)
        assert all(table.ids(n) == v.merge(data[:n]) for n in range(len(data) + 1))
        assert v.encode(data) == v.merge(data)


def test_appends_and_edits(ranks):
    random.seed(9)
    v = bpe.Vocabulary(ranks)
    table = bpe.PrefixTable(v, b"the quick brown fox " * 300)
    most = 0
    for _ in range(60):
        a = random.randint(0, len(table.data))
        b = min(len(table.data), a + random.randint(0, 6))
        most = max(most, table.replace(a, b, bytes(random.choices(b"abc the", k=random.randint(0, 6)))))
        assert table.last == bpe.PrefixTable(v, table.data).last
    assert most < 400  # near the edit, not to the end
    table.append(b" and more")
    assert table.last == bpe.PrefixTable(v, table.data).last


def test_query_equals_the_library(spark, library):
    def sha(b):
        return hashlib.sha256(b).hexdigest()

    want = []
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode_bytes(ids))))
    assert sorted(tuple(r) for r in op5_byte_bpe(spark, SF).collect()) == sorted(want)


def test_odd_rows(spark, library):
    data = [(1, None), (2, ""), (3, "  "), (4, "a b"), (4, "a b"), (None, "é" * 20000), (6, "x\ny")]
    df = spark.createDataFrame([(i, t, "clash", 5) for i, t in data], "doc_id bigint, text string, ids string, decoded int")
    done = bpe.decode(bpe.encode(df, "text", RANKS, public_tokenizers.PATTERN), "ids", RANKS).collect()
    assert [(r.doc_id, r.text, r.ids, bytes(r.decoded)) for r in done] == [
        (i, t, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in data]
    assert bpe.encode(df.limit(0), "text", RANKS, public_tokenizers.PATTERN).count() == 0
    none = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(none, "ids", RANKS).collect()] == [b"", b""]


def test_unknown_id_raises(spark):
    with pytest.raises(Exception, match="out of bounds|vocabulary does not have"):
        bpe.decode(spark.createDataFrame([([99999999],)], "ids array<int>"), "ids", RANKS).collect()
