"""Operators 1, 8 and 9 against the tokenizer libraries, on whole edge cases."""

import base64
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusloom.llm.byte_bpe import ByteBpe, encode_decode
from corpusloom.llm.packing import INSTRUCTION, Limits, Packer, pack_documents
from corpusloom.llm.token_shards import read_token_shards, shard_digest, write_token_shards

TEXTS = [(5, "the cat  sat\n\n on the mat. "), (1, None), (3, ""), (2, "x" * 30_000), (9, "Ünïcode çé 12345 'tis <|endoftext|>"), (7, "same text"), (8, "same text"), (None, "no id"), (4, " \t\n "), (6, "word " * 9000)]
FIELDS = "doc_id long, text string, start string, ids string"


def docs(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], FIELDS)


def library_ids(name, text, end=(2,)):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    return t.encode(text or "", add_special_tokens=False).ids + list(end)


def test_shards_hold_all_documents_in_order(spark, tmp_path):
    path = f"{tmp_path}/shards"
    write_token_shards(docs(spark), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    got = sorted(shard_digest(read_token_shards(spark, path)).collect(), key=lambda r: r.start)
    wanted = sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r.doc_id for r in got] == [i for i, _ in wanted]
    start = 0
    for row, (_, text) in zip(got, wanted):
        ids = library_ids("byte_bpe_50k.json", text)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_starts_hold_when_the_session_splits_files(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "3")
    try:
        write_token_shards(docs(spark), f"{tmp_path}/cut", public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    rows = sorted(shard_digest(read_token_shards(spark, f"{tmp_path}/cut")).collect(), key=lambda r: r.start)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))] and len(rows) == len(TEXTS)


def test_files_have_run_lengths_row_indexes_and_bloom_filters(spark, tmp_path):
    """What the ORC reader itself says of a file; and that filters on doc_id read few rows."""
    path = f"{tmp_path}/orc"
    BASE = 1 << 40  # so that the gateway hands the values on as longs
    rows = spark.range(30_000).select((F.col("id") * 2 + BASE).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    write_token_shards(rows, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    from py4j.java_gateway import get_field

    jvm = spark._jvm
    conf = jvm.org.apache.hadoop.conf.Configuration()
    names = sorted(str(p) for p in tmp_path.glob("orc/part-*.orc"))
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(names[0]), jvm.org.apache.orc.OrcFile.readerOptions(conf))
    assert reader.getRowIndexStride() == 1000 and reader.getCompressionKind().toString() == "ZSTD"
    footer = reader.rows().readStripeFooter(reader.getStripes().get(0))
    kinds = {(s.getKind().toString(), s.getColumn()) for s in footer.getStreamsList()}
    assert ("BLOOM_FILTER_UTF8", 1) in kinds and {("ROW_INDEX", c) for c in range(1, 6)} <= kinds
    assert {footer.getColumns(c).getKind().toString() for c in (1, 2, 3, 5)} == {"DIRECT_V2"}  # integers by run-length encoding
    one = read_token_shards(spark, path).where(F.col("doc_id") == BASE + 20_000)
    assert one.count() == 1 and f"EqualTo(doc_id,{BASE + 20_000})" in one._jdf.queryExecution().toString()
    options = jvm.org.apache.orc.OrcFile.readerOptions(conf)

    def read(value):
        """Rows that the reader gives for doc_id = value: whole row groups, after statistics and Bloom filters."""
        n = 0
        sarg = jvm.org.apache.hadoop.hive.ql.io.sarg.SearchArgumentFactory.newBuilder().equals("doc_id", jvm.org.apache.hadoop.hive.ql.io.sarg.PredicateLeaf.Type.LONG, value).build()
        for name in names:
            r = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(name), options)
            batch, found = r.getSchema().createRowBatch(), r.rows(r.options().searchArgument(sarg, spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)))
            while found.nextBatch(batch):
                n += get_field(batch, "size")
        return n

    assert 0 < read(BASE + 20_000) <= 1000  # one row group of 30
    assert sum(read(BASE + v) > 0 for v in range(1, 59_999, 6000)) <= 2  # odd ids lie within the ranges: the Bloom filters know


def test_encoders_give_the_plain_calls_ids():
    from corpusloom.llm.tokens import PieceEncoder
    from tokenizers import Tokenizer

    draw = random.Random(12)
    parts = ["a", "the", " ", "\n", "  ", "é", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "İ", "1", "'s", ".", "x", "\u00a0", "\u2028", "e\u0301"]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        own, library = PieceEncoder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
        assert own.by_pieces
        texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(30))) for _ in range(400)] + [None, "", "<|endoftext|>"]
        wanted = [np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert own.encode(texts) == wanted and [own.encode([t])[0] for t in texts] == wanted


def test_other_tokenizers_get_whole_texts(tmp_path):
    """One whose words hold blanks: pieces would not do."""
    import json

    from corpusloom.llm.tokens import PieceEncoder

    vocabulary = {x: i for i, x in enumerate(["a", "b", " ", "a b"])}
    (tmp_path / "t.json").write_text(json.dumps({"version": "1.0", "added_tokens": [], "normalizer": None, "pre_tokenizer": None, "post_processor": None, "decoder": None, "model": {"type": "BPE", "vocab": vocabulary | {"a ": 4}, "merges": [["a", " "], ["a ", "b"]]}}))
    own = PieceEncoder(str(tmp_path / "t.json"))
    assert not own.by_pieces and np.frombuffer(own.encode(["a b"])[0], "<u4").tolist() == [3]


def test_empty_shards(spark, tmp_path):
    write_token_shards(docs(spark, []), f"{tmp_path}/none", public_tokenizers.path("byte_bpe_50k.json"))
    assert spark.read.schema("doc_id long, shard_start long, n_tokens long, ids array<int>").orc(f"{tmp_path}/none").count() == 0


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def test_backtracking_equals_merging(bpe):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(7)
    texts = [t or "" for _, t in TEXTS] + ["ab" * 4000]
    texts += ["".join(draw.choice("abehtinos çß \n'") for _ in range(draw.randrange(400))) for _ in range(200)]
    texts += ["".join(chr(draw.randrange(32, 0xD000)) for _ in range(2000))]
    for text, ids in zip(texts, bpe.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_patterns_that_span_blanks():
    import tiktoken

    ranks = {bytes([i]): i for i in range(256)} | {b"a b": 256, b"a ": 257}
    pattern = r"[a-z]+ [a-z]+|\s|[a-z]+"
    own, library = ByteBpe(ranks, pattern), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    assert not own.by_pieces
    for text in ("a b", "a b a b", "x a b"):
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_encode_decode_rows(spark):
    rows = encode_decode(docs(spark), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or -1, bytes(r.decoded)) for r in rows) == sorted((i or -1, (t or "").encode()) for i, t in TEXTS)
    assert all(r.n_tokens * 4 == len(r.token_ids) for r in rows)
    assert encode_decode(docs(spark, []), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("limits", [Limits(4096, 256, 4096), Limits(512, 3, 200), Limits(64, 2, 64)])
def test_packing_keeps_every_id_once_within_limits(spark, limits):
    rows = pack_documents(docs(spark, TEXTS[:7] + TEXTS[8:]), public_tokenizers.path("word_bpe_49k.json"), 2, limits, keep_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, text in TEXTS[:7] + TEXTS[8:]:
        if i is None:
            continue
        ids = library_ids("word_bpe_49k.json", text)
        own = sorted(pieces[i], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in own) == np.array(ids, "<u4").tobytes()
        assert all(r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in own)
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        total = sum(r.length for r in own)
        assert [r.offset for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert total <= limits.tokens and len(own) <= limits.segments and sum(r.loss_tokens for r in own) <= limits.loss
        assert total == limits.tokens or total & (total - 1) == 0


@pytest.mark.parametrize("kind", ["smallint", "decimal(10,0)", "string", "int"])
def test_packing_keeps_id_types(spark, kind):
    rows = docs(spark, [(1, "a b"), (2, None)]).withColumn("doc_id", F.col("doc_id").cast(kind)).withColumn("ids_crc32", F.lit("clash"))
    got = pack_documents(rows, public_tokenizers.path("word_bpe_49k.json"), 2)
    assert got.schema["doc_id"].dataType == rows.schema["doc_id"].dataType and sorted(str(r.doc_id) for r in got.collect()) == ["1", "1", "2"][: got.count()]
    assert pack_documents(rows.where("false"), public_tokenizers.path("word_bpe_49k.json"), 2).count() == 0


def lengths(packer, examples):
    out = []
    for i, (n, start) in enumerate(examples):
        out += packer.add(i, bytes(4 * n), start)
    return out + list(packer.finish())


def test_the_dot_product_chooses_by_all_limits():
    """With room for few loss-bearing tokens, the piece that leaves the scarce room alone goes in, and not the one that best
    fits by tokens."""
    prompt, answer = (60, 60), (64, 0)  # all prompt, and all loss
    free = Packer(Limits(128, 8, 128))
    bound = Packer(Limits(128, 8, 40))
    assert [sorted(x.doc for x in s) for s in lengths(free, [prompt, answer, answer])][0] == [1, 2]
    sequences = lengths(bound, [prompt, answer, answer])
    assert all(sum(x.loss for x in s) <= 40 and sum(x.tokens for x in s) <= 128 for s in sequences)
    assert 0 in {x.doc for s in sequences[:2] for x in s} and sum(x.tokens for s in sequences for x in s) == 188


def test_the_loss_limit_binds_in_the_registered_setting():
    draw = random.Random(2)
    examples = [(draw.randrange(50, 1500), draw.randrange(0, 4)) for _ in range(800)]
    sequences = lengths(Packer(INSTRUCTION), examples)
    assert any(sum(x.loss for x in s) == INSTRUCTION.loss for s in sequences)
    assert all(sum(x.loss for x in s) <= INSTRUCTION.loss and len(s) <= INSTRUCTION.segments for s in sequences)
    whole = [sum(x.tokens for x in s) for s in sequences]
    assert sum(whole) == sum(n for n, _ in examples) and all(n == 4096 or n & (n - 1) == 0 for n in whole)


def test_prompt_line(spark):
    rows = spark.createDataFrame([(1, "question of five words\n" + "answer " * 30), (2, "one line"), (3, None)], "doc_id long, text string")
    got = pack_documents(rows, public_tokenizers.path("word_bpe_49k.json"), 2, prompt_line=True).groupBy("doc_id").agg(F.sum("length").alias("n"), F.sum("loss_tokens").alias("loss")).collect()
    assert {r.doc_id: (r.n, r.loss) for r in got} == {1: (35, 31), 2: (3, 3), 3: (1, 1)}


def test_packing_mixes_prompt_and_answer_loads(spark):
    rows = spark.createDataFrame([(i, "word " * 40, 35 if i % 2 else 0) for i in range(60)], "doc_id long, text string, prompt int")
    got = pack_documents(rows, public_tokenizers.path("word_bpe_49k.json"), 2, Limits(128, 8, 64), "prompt").collect()
    assert sum(r.length for r in got) == 60 * 41
    assert sum(r.loss_tokens for r in got) == 30 * 41 + 30 * 6
