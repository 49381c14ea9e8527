"""Operators whose results are fixed exactly: top-k search, token files, chat formatting, BPE, WARC."""

import base64
import hashlib
import io
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from caseloom.llm import bpe, chat, text, tokenfile, topk, warc
from caseloom.llm.registry import ORACLES, QUERIES
from caseloom.session import scratch_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", " ", "  a  b ", "It's \n\n  fine.\n x\t y ", "日本語 テキスト 😀 ñ", "a" * 3000, "foo \x1cbar  <|endoftext|> 123 !!!", "a <|endoftext|> b", "<|endoftext|>", "word " * 2000, "word " * 2000]


@pytest.mark.parametrize("name", ["op1_exact_top_k", "op5_chat_format", "op8_warc"])
def test_against_sql(spark, folder, name):
    from oracle import compare, connect

    found = [p for p in compare(spark, connect(folder), QUERIES[name], ORACLES[name], folder) if not p.startswith("plan has")]
    assert found == []


# --- top-k


def brute(vectors, k):
    whole = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    whole = sorted(set((i, tuple(v)) for i, v in whole))
    out = []
    for i, q in whole:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def test_top_k_edge_cases(spark):
    draw = random.Random(5)
    vectors = [(i, [draw.gauss(0, 1) for _ in range(33)]) for i in range(300)]
    vectors += [(i, [1.0] * 33) for i in range(300, 420)]  # ties
    vectors += [(500, None), (501, []), (502, [None] * 33), (503, [float("nan")] + [0.0] * 32), (504, [float("inf")] * 33), (None, [1.0] * 33), (550, [1.0, 2.0]), (551, [3.0, 4.0])]
    vectors += [(0, vectors[0][1])]  # a repeated row
    vectors += [(600, [3e6] * 33), (601, [-2e7] * 33)]
    frame = spark.createDataFrame([(i, v, 7, "x") for i, v in vectors], "vec_id bigint, embedding array<double>, score int, rank string")
    queries = frame.where("vec_id % 50 = 0")
    for block in (64, 8192):
        got = topk.exact_top_k(frame, queries, 5, step=8, query_block=3, candidate_block=block).select("query_id", "rank", "vec_id", "score")
        assert sorted(map(tuple, got.collect())) == brute(vectors, 5)
    assert topk.exact_top_k(frame.limit(0), queries.limit(0)).count() == 0


# --- pieces and BPE


def plain_encoding():
    ranks = bpe.load_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab 'st\n\t \x1c é9!.")), max_size=60))
def test_pieces_join(value):
    found = text.pieces(value)
    assert " ".join(found) == value


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(alphabet=st.sampled_from(list("abeht 'sr\n\t \x1c é9!.")), max_size=80), st.text(max_size=30)))
def test_encoders_equal_the_libraries(value):
    ids = bpe.encoder(RANKS, public_tokenizers.PATTERN).encode(value)
    assert np.frombuffer(ids, "<u4").tolist() == plain_encoding.cached.encode_ordinary(value)
    assert bpe.encoder(RANKS, public_tokenizers.PATTERN).decode(ids) == value.encode()
    assert np.frombuffer(tokenfile.piece_encoder(JSON)([value])[0], "<u4").tolist() == plain_encoding.library.encode(value, add_special_tokens=False).ids


plain_encoding.cached = plain_encoding()
plain_encoding.library = Tokenizer.from_file(JSON)


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=60), st.binary(max_size=20), st.integers(0, 60), st.integers(0, 60))
def test_prefix_table_appends_and_edits(data, more, a, b):
    coder = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    start, stop = sorted((min(a, len(data)), min(b, len(data))))
    grown = bpe.PrefixTable(coder, data)
    grown.append(more)
    assert grown.ids() == bpe.PrefixTable(coder, data + more).ids() == coder.merge(data + more)
    edited = bpe.PrefixTable(coder, data)
    edited.replace(start, stop, more)
    assert edited.ids() == coder.merge(data[:start] + more + data[stop:])


def test_edit_stops_early():
    coder = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    data = b"the quick brown fox jumps over the lazy dog " * 100
    table = bpe.PrefixTable(coder, data)
    assert table.replace(10, 12, b"XYZ") < 400
    assert table.ids() == bpe.PrefixTable(coder, table.data).ids()


def documents(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(None, "no key", "x", 1), (3, TEXTS[3], "x", 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string, n_tokens int").repartition(3)


def test_bpe_documents(spark):
    got = bpe.encode_documents(documents(spark), RANKS, public_tokenizers.PATTERN)
    want = []
    for row in documents(spark).collect():
        ids = np.array(plain_encoding.cached.encode_ordinary(row.text or ""), "<u4")
        want.append((row.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((row.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert bpe.encode_documents(documents(spark).limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    kept = bpe.encode_documents(documents(spark), RANKS, public_tokenizers.PATTERN, keep_ids=True).where("doc_id = 4").first()
    assert kept.ids == plain_encoding.cached.encode_ordinary(TEXTS[4])


# --- token files


def test_token_files(spark):
    got = sorted(map(tuple, tokenfile.token_table(documents(spark), JSON).select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 0, 1, 2, 3, 3, *range(4, len(TEXTS))]
    start = 0
    for key, at, n, crc in got:
        value = "no key" if key is None else TEXTS[key]
        ids = np.array([*plain_encoding.library.encode(value or "", add_special_tokens=False).ids, 2], "<u4")
        assert (at, n, crc) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += n
    assert tokenfile.token_table(documents(spark).limit(0), JSON).count() == 0


def test_many_files_and_small_frames(spark):
    folder = scratch_path(spark, "tokens")
    frame = spark.createDataFrame([(i, f"text {i} " * (i % 7)) for i in range(200)], "doc_id bigint, text string")
    files = tokenfile.write_tokens(frame, folder, JSON, 2, file_bytes=500)
    assert files.count() > 3
    assert tokenfile.read_tokens(files, folder).agg({"n_tokens": "sum"}).first()[0] == files.agg({"n_tokens": "sum"}).first()[0]


def token_file(documents, frame_bytes=64):
    sink = io.BytesIO()
    writer = tokenfile.TokenWriter(sink, pa.int64(), frame_bytes)
    for key, ids in documents:
        writer.add(key, np.array(ids, "<u4").tobytes())
    writer.close()
    return sink.getvalue()


def test_reader_touches_only_needed_frames():
    docs = [(i, list(range(i, i + 20))) for i in range(100)]
    reader = tokenfile.TokenReader(io.BytesIO(token_file(docs)))
    assert np.frombuffer(reader.document(57), "<u4").tolist() == docs[57][1]
    assert reader.frames_read == 1 and len(reader.table) > 20
    assert [np.frombuffer(reader.document(i), "<u4").tolist() for i in range(100)] == [d for _, d in docs]


def test_any_zstandard_decoder_reads_the_file():
    import zstandard

    data = token_file([(1, [1, 2, 3]), (None, []), (2, list(range(100)))])
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert np.frombuffer(plain, "<u4").tolist() == [1, 2, 3, *range(100)]


def test_damaged_frame_is_noticed():
    data = bytearray(token_file([(i, [i] * 30) for i in range(10)]))
    data[9] ^= 255
    reader = tokenfile.TokenReader(io.BytesIO(bytes(data)))
    with pytest.raises(Exception):
        reader.document(0)
    assert np.frombuffer(reader.document(9), "<u4").tolist() == [9] * 30


# --- chat


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool ]x", ""]),
                          st.lists(st.sampled_from(["[INST]", "[/INST]", " [/INST]", "</s>", "<\\/s>", "[\\\\OUT", "[SYS] ", "[ROLE x] ", "[", "<", "\\", " ", "a", "\n", "é"]), max_size=8).map("".join)), max_size=6))
def test_chat_round_trip(turns):
    assert [t[:2] for t in chat.parse("".join(chat.render(*t)[0] for t in turns))] == turns


def test_unescaped_control_string_is_refused():
    for bad in ("[INST] a", "[INST] a</s> [/INST]", "x", "[OUT] [INST] </s>", "[ROLE] a [/ROLE]"):
        with pytest.raises(chat.GrammarError):
            chat.parse(bad)


def test_conversations(spark):
    long = [(5, i, ["user", "assistant"][i % 2], f"t{i} </s>") for i in range(500)]
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (None, 0, None, "x"), (2, None, "user", "b"), (2, 1, "user", "a"), (2, 1, "user", "a"), (3, 0, "assistant", ""), *long]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted int").repartition(4)
    written = chat.format_conversations(frame, scratch_path(spark, "chat"), part_chars=200)
    assert written.where("conv_id = 5").count() > 10
    got = {r.conv_id: r for r in chat.read_conversations(written).collect()}
    for key in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        row = got[key]
        assert (row.n_turns, row.turns_sha256) == (len(mine), hashlib.sha256(whole.encode()).hexdigest())
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert row.formatted_chars == sum(len(chat.render(r[2] or "", r[3] or "")[0]) for r in mine)
    assert chat.read_conversations(chat.format_conversations(frame.limit(0), scratch_path(spark, "chat"))).count() == 0


# --- WARC


def members(n=20, plain=False):
    draw = random.Random(3)
    records = [warc.build_record(i, f"http://x/{i}\r\nEvil: 1", bytes(draw.choices(range(256), k=draw.randrange(3000))), None if i % 5 else i - 1) for i in range(1, n)]
    return records if plain else [warc.gzip_member(r) for r in records]


@pytest.mark.parametrize("plain", [False, True])
def test_salvage(plain):
    parts = members(plain=plain)
    reader = warc.SalvageReader(io.BytesIO(b"".join(parts)), chunk=1 << 12)
    assert [h["warc-record-id"] for _, h, _ in reader] == [f"<urn:page:{i}>" for i in range(1, 20)] and reader.gaps == []
    broken = bytearray(b"".join(parts))
    starts = np.cumsum([0, *map(len, parts)])
    broken[starts[5] - 20 if plain else starts[4] + 30] ^= 0x55
    broken[starts[9] : starts[9] + 50] = b"\x1f\x8b\x08WARC/1." + bytes(40)
    data = bytes(broken[: starts[12]]) + b"garbage WARC/1.1\r\nbad" + bytes(broken[starts[12] : -40])
    reader = warc.SalvageReader(io.BytesIO(data), chunk=1 << 12)
    found = [h["warc-record-id"] for _, h, _ in reader]
    assert found == [f"<urn:page:{i}>" for i in range(1, 20) if i not in (5, 10, 19)]
    assert [(a, b) for a, b, _ in reader.gaps] == [(starts[4], starts[5]), (starts[9], starts[10]), (starts[12], starts[12] + 21), (starts[18] + 21, len(data))]


def test_archives(spark):
    pages = [(5, "u", "same"), (3, "u", "same"), (4, None, None), (9, "u", ""), (3, "u", "same"), (None, "u", "same"), (7, "u\n", "ü" * 70_000), (8, "v", "one")]
    frame = spark.createDataFrame([(*p, 1) for p in pages], "page_id bigint, url string, html string, digest int").repartition(3)
    folder = scratch_path(spark, "warc")
    got = warc.read_archives(warc.write_archives(frame, folder, file_bytes=100), folder)
    rows = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in got.collect()), key=repr)
    assert rows == sorted([(5, "revisit", 3, 4), (3, "response", None, 4), (3, "response", None, 4), (None, "revisit", 3, 4), (4, "response", None, 0),
                           (9, "revisit", 4, 0), (7, "response", None, 140_000), (8, "response", None, 3)], key=repr)
    assert {r.payload_digest for r in got.where("payload_bytes = 4").collect()} == {base64.b32encode(hashlib.sha1(b"same").digest()).decode()}
    small = warc.read_archives(warc.write_archives(frame, scratch_path(spark, "warc"), min_bytes=4), folder)
    assert small.where("record_type = 'revisit' and payload_bytes < 4").count() == 0
    assert warc.write_archives(frame.limit(0), scratch_path(spark, "warc")).count() == 0


def test_damaged_archive_in_a_job(spark, tmp_path):
    parts = members()
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts[:3]) + b"\0" * 99 + b"".join(parts[3:]))
    files = spark.createDataFrame([(str(tmp_path / "a.warc.gz"),)], "path string")
    got = warc.read_archives(files, str(tmp_path))
    gap = got.where("kind = 'gap'").collect()
    assert got.where("kind = 'record'").count() == 19 and [(g.start, g.end) for g in gap] == [(sum(map(len, parts[:3])), sum(map(len, parts[:3])) + 99)]


def test_piece_memo_is_bounded():
    import public_tokenizers

    from caseloom.llm.text import Memo
    from caseloom.llm.tokenfile import PieceEncoder

    encode = PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    encode.memo.limit = 50
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(20)] + ["y" * 5_000 + " " + "z" * 5_000]
    for text in texts:
        assert encode([text]) == [encode._ids(text).tobytes()]
        assert len(encode.memo) <= 50 and len(encode.memo.old) <= 50
    assert max(map(len, [*encode.memo, *encode.memo.old, *encode.first])) <= Memo.LONGEST
    memo = Memo(lambda key: key * 2, size=100)
    assert [memo["a" * 20 + str(i)][:1] for i in range(9)] == ["a"] * 9 and sum(map(len, memo)) <= 100


def test_pieces_of_a_group_are_encoded_once_whatever_the_memo_holds():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode = tokenfile.PieceEncoder(path)
    encode.memo.limit = 10
    calls, ids_of = [], encode._ids
    encode._ids = lambda piece: calls.append(piece) or ids_of(piece)
    texts = ["start " + " ".join(f"word{i}x" for i in range(500))] * 2
    encode(["start " + " ".join(f"word{i}x" for i in range(0, 500, 50))])
    del calls[:]
    plain = Tokenizer.from_file(path)
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == [plain.encode(x, add_special_tokens=False).ids for x in texts]
    assert len(calls) <= 2


def test_words_are_encoded_once_whatever_mark_or_line_they_stand_in():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, plain = tokenfile.PieceEncoder(path), Tokenizer.from_file(path)
    words = ["".join(w) for w in itertools.product("abé", "rst", "uvw", "öxy")]
    texts = ["start " + " ".join(w + mark for w in words) + " end" for mark in ("", ".", ",", "!", "..", ".\u0301", "1,")]
    texts += ["start " + " ".join(f"{a}{mark}\n{b}" for a, b in zip(words, reversed(words))) for mark in ("", ".", "\n", ".\n.")]
    size, ids_of = [], encode._ids
    encode._ids = lambda piece: size.append(len(piece)) or ids_of(piece)
    for group in ([texts[0]], [" ".join("x\n" + w for w in words)], texts[1:4], texts[7:9]):
        assert [np.frombuffer(x, "<u4").tolist() for x in encode(group)] == [plain.encode(x, add_special_tokens=False).ids for x in group]
    # Once behind a space and once behind a line feed, and little more.
    assert sum(size) < 2 * len(" ".join(words)) + 100
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == [plain.encode(x, add_special_tokens=False).ids for x in texts]


def test_tokens_fit_without_merging_their_bytes():
    draw, checked = random.Random(4), {True: 0, False: 0}
    for letters, size in (("ab", 30), ("abc", 60)):
        for _ in range(40):
            tokens = list(dict.fromkeys([*letters, *("".join(draw.choices(letters, k=draw.randrange(2, 7))) for _ in range(size))]))
            draw.shuffle(tokens)
            table = bpe.PrefixBpe({token.encode(): rank for rank, token in enumerate(tokens)})
            stable = [rank for rank in range(len(tokens)) if table.stable[rank]]
            for pair in ((a, b) for a in stable for b in stable):
                found = table.compatible[pair]
                assert found == (table.merge(table.bytes_of[pair[0]] + table.bytes_of[pair[1]]) == list(pair))
                checked[found] += 1
    assert min(checked.values()) > 100
    table = bpe.PrefixBpe(bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    merged, merge = [], table.merge
    table.merge = lambda data: merged.append(data) or merge(data)
    table.encode("qzxv kwjqa zzxqv jjwqk")
    assert set(merged) <= set(table.ranks)


def test_groups_of_texts_keep_their_order(monkeypatch):
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts = ["one two three", None, "", "four five", "six", " seven  eight", "nine"]
    want = bpe.PrefixBpe(ranks, public_tokenizers.PATTERN).encode_all(texts)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 5)
    table = bpe.PrefixBpe(ranks, public_tokenizers.PATTERN)
    table.chunks.limit = table.words.limit = 1
    assert table.encode_all(texts) == want and [table.decode(ids).decode() for ids in want] == [text or "" for text in texts]


def test_tails_bound_the_search_for_tokens():
    class Counted(dict):
        asked = 0

        def get(self, *key):
            self.asked += 1
            return super().get(*key)

    ranks = Counted(bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    draw = random.Random(3)
    data = "".join(draw.choice("qxzjkvw") for _ in range(120)).encode()
    table = bpe.PrefixBpe(ranks)
    want = tuple(table.merge(data))
    ranks.asked = 0
    table.stable.make = table.compatible.make = lambda _: True
    bpe.PrefixTable(table, data)
    # All starts of all prefixes would be 7,000.
    assert ranks.asked < 1_000
    assert bpe.PrefixBpe(ranks).encode_match(data) == want
