"""Token operators against the libraries used plainly, one text at a time."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from awardloom.llm import bpe, eliasfano, packing
from awardloom.llm.common import arrow_uri, crc, filesystem
from awardloom.session import fresh_dir

TEXTS = [
    "It is a plain text. And, well, it's one more line.\nNext line here.",
    "", None, " ", "\n", "a", " a", "a ", "a  b", "x\ny", "x \ny", "\n\nx", "a\tb c\x0bd", "tab\t", "\x02 y\x02",
    "Ärger über Straße, ÀÉ İstanbul ΣΑΣ", "　wide　space \x85 next", "<|endoftext|> is text", "日本語 テキスト 🙂🙂",
    "é é x́", "$$$, %%%. ...", "12,345.67 8", "word " * 3000, "z" * 5000, "It is a plain text. And, well, it's one more line.\nNext line here.",
]
WORD, BYTE, MULTI = map(P.path, ("word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(7 * i - 3, t, "clash", i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, shard int").repartition(3)


def plain(path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids for x in TEXTS]


def u4(ids):
    return np.asarray(ids, "<u4").tobytes()


@pytest.mark.parametrize("universe", [1, 2, 63, 64, 1000, 10**6, 2**40])
@pytest.mark.parametrize("n", [0, 1, 2, 64, 65, 500])
def test_elias_fano_round_trip(n, universe):
    rng = np.random.default_rng(n + universe % 97)
    values = np.sort(rng.integers(0, universe, n)).astype(np.uint64)
    ef = eliasfano.EliasFano.from_bytes(eliasfano.EliasFano.of(values).to_bytes())
    assert [ef.select(i) for i in range(n)] == values.tolist()
    assert ef.between(0, n).tolist() == values.tolist()
    for a, b in ((0, 1), (1, n), (n // 2, n), (63, 65), (64, 64)):
        if a <= b <= n:
            assert ef.between(a, b).tolist() == values[a:b].tolist()
    with pytest.raises(IndexError):
        ef.select(n)


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(100, 2000, 50_000)).astype(np.uint64)
    assert 8 * len(eliasfano.EliasFano.of(values).to_bytes()) / len(values) < 2 + np.log2(values[-1] / len(values)) + 1.5


def test_addresses_as_arrow_names_them():
    assert arrow_uri("s3a://bucket/a/b") == "s3://bucket/a/b" and arrow_uri("hdfs://host:8020/a") == "hdfs://host:8020/a"
    assert arrow_uri("file:/a/b") == arrow_uri("file:///a/b") == "file:///a/b"
    assert filesystem("file:/a/b")[1] == filesystem("/a/b")[1] == "/a/b"


def test_token_files(spark, docs):
    want, before = [], 0
    for i, ids in enumerate(plain(WORD)):
        want.append((7 * i - 3, before, len(ids) + 1, zlib.crc32(u4([*ids, 2]))))
        before += len(ids) + 1
    folder = fresh_dir(spark, "test-ids")
    files = eliasfano.write_token_files(spark, docs, WORD, 2, folder, shard_documents=4)
    assert len(files.shards) > 3
    assert sorted(map(tuple, eliasfano.digest_token_files(spark, files).collect())) == want
    got = {r.doc_id: r.ids for r in eliasfano.read_token_files(spark, files).collect()}
    assert {k: crc(v) for k, v in got.items()} == {w[0]: w[3] for w in want}
    reader = eliasfano.ShardReader(f"{folder}/{files.shards[1][0]}")
    for i in range(reader.n):
        assert reader.find(reader.doc_id(i)) == i and u4(reader.ids(i)) == got[reader.doc_id(i)]
    assert reader.find(10**9) is None


def test_token_files_null_ids_repeated_rows_empty_table(spark):
    rows = [(None, "b"), (5, "x"), (5, "x"), (5, "a"), (None, None), (-(2**63), "m"), (2**63 - 1, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    files = eliasfano.write_token_files(spark, df, WORD, 2, fresh_dir(spark, "test-ids"), shard_documents=100)
    got = eliasfano.digest_token_files(spark, files).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, -(2**63), 5, 5, 5, 2**63 - 1]
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    empty = eliasfano.write_token_files(spark, df.limit(0), WORD, 2, fresh_dir(spark, "test-ids"))
    assert eliasfano.digest_token_files(spark, empty).count() == 0


@pytest.fixture(scope="module")
def tik():
    import tiktoken

    with open(MULTI, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken(spark, docs, tik):
    got = {r.doc_id: r for r in bpe.round_trip(spark, docs, MULTI, P.PATTERN).collect()}
    for i, text in enumerate(TEXTS):
        ids, r = tik.encode_ordinary(text or ""), got[7 * i - 3]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(u4(ids)).hexdigest()), text
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    encoded = bpe.encode(spark, docs, MULTI, P.PATTERN)
    back = {r.doc_id: bytes(r.data).decode() for r in bpe.decode(spark, encoded, MULTI, P.PATTERN).collect()}
    assert back == {7 * i - 3: t or "" for i, t in enumerate(TEXTS)}
    assert bpe.encode(spark, docs.limit(0), MULTI, P.PATTERN).count() == 0


def test_bpe_equals_tiktoken_on_the_table(spark, tik):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r.ids_sha256 for r in bpe.round_trip(spark, df, MULTI, P.PATTERN).collect()}
    assert got == {r.doc_id: hashlib.sha256(u4(tik.encode_ordinary(r.text))).hexdigest() for r in df.collect()}


LIMITS = packing.Limits(1024, 64, 640)


def check_packing(rows, tokens, limits=LIMITS):
    """rows: of pack_texts; tokens: doc_id -> ids with the end id. Every id lies in one piece, no limit is passed."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(tokens)
    for doc_id, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(tokens[doc_id])
            assert p.ids_crc32 == zlib.crc32(u4(tokens[doc_id][at : at + p.length]))
            at += p.length
        assert at == len(tokens[doc_id])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= limits.tokens and len(pieces) <= limits.segments and sum(p.n_loss for p in pieces) <= limits.loss
        padding += 0 if at & (at - 1) == 0 else limits.tokens - at
    return padding


def test_packing_of_texts(spark, docs):
    tokens = {7 * i - 3: [*ids, 0] for i, ids in enumerate(plain(BYTE))}
    assert check_packing(packing.pack_texts(spark, docs, BYTE, 0, LIMITS).collect(), tokens) == 0
    for tight in (packing.Limits(100, 3, 60), packing.Limits(128, 3, 60)):
        rows = packing.pack_texts(spark, docs, BYTE, 0, tight).collect()
        padding = check_packing(rows, tokens, tight)
        assert padding == 0 or tight.tokens == 100
    for percent in (0, 100):
        assert check_packing(packing.pack_texts(spark, docs, BYTE, 0, LIMITS, prompt_percent=percent).collect(), tokens) == 0
    few = docs.where("length(text) < 300 or text is null")
    some = {r.doc_id: tokens[r.doc_id] for r in few.collect()}
    for tiny in (packing.Limits(1, 1, 1), packing.Limits(64, 64, 1)):
        assert check_packing(packing.pack_texts(spark, few, BYTE, 0, tiny).collect(), some, tiny) == 0
    with pytest.raises(ValueError):
        packing.pack_texts(spark, docs, BYTE, 0, packing.Limits(5, 0, 1))
    assert packing.pack_texts(spark, docs.limit(0), BYTE, 0, LIMITS).count() == 0


def test_short_texts_need_no_padding(spark):
    """64 segments of five tokens are far from a full sequence."""
    df = spark.createDataFrame([(i, "one two three four") for i in range(3000)], "doc_id long, text string").coalesce(2)
    rows = packing.pack_texts(spark, df, BYTE, 0, LIMITS).collect()
    ids = [*plain_of("one two three four"), 0]
    tokens = dict.fromkeys(range(3000), ids)
    assert check_packing(rows, tokens) == 0
    assert sum(r.length for r in rows) / len({r.sequence_id for r in rows}) > 200


def plain_of(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE).encode(text, add_special_tokens=False).ids


def test_the_limit_on_loss_binds(spark):
    """With it, answers are mixed with prompts; without it, some sequences would bear more."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)

    def sequences(limits):
        out = {}
        for r in packing.pack_texts(spark, df, BYTE, 0, limits).collect():
            n, loss = out.get(r.sequence_id, (0, 0))
            out[r.sequence_id] = n + r.length, loss + r.n_loss
        return list(out.values())

    bound, free = sequences(LIMITS), sequences(LIMITS._replace(loss=1024))
    assert max(s for _, s in bound) == 640 and sum(s == 640 for _, s in bound) > len(bound) / 10
    assert sum(s > 640 for _, s in free) > len(free) / 10
    assert sum(n == 1024 for n, _ in bound) > 0.97 * len(bound)


def test_packing_of_the_table(spark):
    from tokenizers import Tokenizer

    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    t = Tokenizer.from_file(BYTE)
    docs = df.collect()
    tokens = {r.doc_id: [*e.ids, 0] for r, e in zip(docs, t.encode_batch([r.text for r in docs], add_special_tokens=False))}
    assert check_packing(packing.pack_texts(spark, df, BYTE, 0, LIMITS).collect(), tokens) == 0


def test_packing_of_whole_examples(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(n), int(n * s)) for i, (n, s) in enumerate(zip(rng.integers(1, 500, 3000), rng.random(3000)))]
    rows += [(1, 10, 5), (2, 2000, 5), (3, 10, 900), (4, None, None), (None, 3, 1)]
    df = spark.createDataFrame(rows, "id long, n long, loss long").repartition(2)
    limits = packing.Limits(1024, 4, 512)
    got = packing.pack(spark, df, limits, "id", "n", "loss").collect()
    assert sorted((r.id or -1, r.n_tokens, r.n_loss) for r in got) == sorted((i or -1, n or 0, s or 0) for i, n, s in rows)
    assert sorted(r.id for r in got if not r.fits) == [2, 3]
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append(r)
    for b in bins.values():
        assert not b[0].fits or (sum(r.n_tokens for r in b) <= 1024 and len(b) <= 4 and sum(r.n_loss for r in b) <= 512)
        at = 0
        for r in sorted(b, key=lambda r: (r.offset, r.n_tokens)):
            assert r.offset == at
            at += r.n_tokens
    # a whole-example packing needs at least the largest share of a limit; the heuristic stays near it
    good = [r for r in got if r.fits]
    least = max(sum(r.n_tokens for r in good) / 1024, sum(r.n_loss for r in good) / 512, len(good) / 4)
    assert len({r.sequence_id for r in good}) < 1.25 * least
