"""Token ids: BPE against the reference library, packing, the id file format, chat formatting."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from lanewise.llm import bpe, chat, idcoder, idmix, packing
from lanewise.llm.common import vocabulary_file
from lanewise.llm.queries import QUERIES, chat_digest
from lanewise.llm.tokens import Encoder

BITS = ["a", "Word", "é", " ", "  ", "\n", "\n\n", "\t", "x1", "'s", "'ll", ",", "\x01", "#", "日本", " ", "\x1c", "́", " the", "1 2", "\r\n", " ", "<|endoftext|>", "ß.", "İ"]


def noise(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_is_the_library(name):
    library = Tokenizer.from_str(vocabulary_file(name))
    library.encode_special_tokens = True
    texts = [None, "", *noise(6000, 1)]
    encoder = Encoder(vocabulary_file(name), cache_bytes=100_000)
    for at in range(0, len(texts), 700):
        part = texts[at : at + 700]
        for ids, e in zip(encoder.encode(part), library.encode_batch([t or "" for t in part], add_special_tokens=False)):
            assert ids.tolist() == e.ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_go_to_the_model(name):
    """Latin words with signs behind them take no way through the library's patterns, and keep its ids."""
    library = Tokenizer.from_str(vocabulary_file(name))
    library.encode_special_tokens = True
    encoder = Encoder(vocabulary_file(name))
    rng = random.Random(5)
    letters = [*"aeinorst" * 9, *map(chr, range(0x41, 0x5B)), *map(chr, range(0xC0, 0x250))]
    signs = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]

    def word():
        stem = "".join(rng.choices(letters, k=rng.randint(1, 12)))
        return stem + "".join(rng.choices(signs, k=rng.choice([0, 0, 0, 1, 1, 3])))

    texts = ["".join(rng.choice([" ", " ", "\n"]) + word() for _ in range(300))[1:] for _ in range(40)]
    texts += ["x" * 5000 + "!" * 700, "don't 'tis dogs' it's. I'LL", "İ", "aª bº c×d e÷", "<|endoftext|> a<|endoftext|>"]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    asked = []
    encoder._ids = lambda texts: asked.extend(texts) or [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    fresh = "Wörter qui viennent,\nzwxv Straße, ÉTÉ pqrst!? nqzt."
    assert encoder.encode([fresh])[0].tolist() == library.encode(fresh, add_special_tokens=False).ids
    assert not any(c.isalpha() for text in asked for c in text)  # at most signs


def test_other_patterns_are_kept():
    """A tokenizer that cuts words itself gets them whole."""
    file = vocabulary_file("word_bpe_49k.json").replace("[\\\\p{L}]+", "[\\\\p{L}]{1,3}")
    assert file != vocabulary_file("word_bpe_49k.json")
    texts = ["Wörter qui viennent, zwxv Straße", "abcdefg abc!"]
    library = Tokenizer.from_str(file)
    assert [x.tolist() for x in Encoder(file).encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_probes_are_not_remembered():
    """The words that show a tokenizer to cut words have its ids afterwards."""
    file = vocabulary_file("word_bpe_49k.json").replace("[\\\\p{L}]+", "[\\\\p{L}]{1,3}")
    text = "so qxzj and éßœɏ"
    assert Encoder(file).encode([text])[0].tolist() == Tokenizer.from_str(file).encode(text, add_special_tokens=False).ids


def test_words_stay_remembered_when_the_room_is_full():
    """A full room is kept until as many words as it holds were encoded anew."""

    class Counted:
        def __init__(self, model):
            self.model, self.n = model, 0

        def tokenize(self, word):
            self.n += 1
            return self.model.tokenize(word)

    library = Tokenizer.from_str(vocabulary_file("byte_bpe_50k.json"))
    encoder = Encoder(vocabulary_file("byte_bpe_50k.json"), cache_bytes=20_000)
    model = encoder.model = Counted(encoder.model)

    def asked(k, n):
        text = " ".join("w" + "".join("aeioubdg"[i >> 3 * j & 7] for j in range(4)) for i in range(k, k + n))
        before = model.n
        assert encoder.encode([text, None, ""])[0].tolist() == library.encode(text, add_special_tokens=False).ids
        return model.n - before

    assert asked(0, 300) == 300 and encoder.held > encoder.cache_bytes
    assert asked(0, 300) == 0  # the first call filled the room; its words stay
    assert asked(1000, 100) == 100 and asked(1000, 100) == 100  # the rest is encoded each time
    assert asked(0, 300) == 0
    assert asked(2000, 200) == 200 and len(encoder.known) > 300
    asked(0, 1)
    assert len(encoder.known) < 10 and asked(0, 300) >= 299  # as many were new as it held: all forgotten


def test_counts_of_many_ids_are_whole():
    """Ids are counted some at a time; the table and the symbols are those of all."""
    ids = np.random.default_rng(3).integers(0, 700, 3 * idmix.SOME + 5).astype(np.uint32)
    ids[-1] = 5000
    table, symbols = idmix.Table.of(ids)
    found, counts = np.unique(ids, return_counts=True)
    assert table.ids.tolist() == found.tolist()
    assert table.frequencies.sum() == 1 << table.bits and (table.symbols.take(symbols) == ids).all()
    share = 1 + counts * ((1 << table.bits) - len(found)) // len(ids)
    assert (np.flatnonzero(table.frequencies != share) == counts.argmax()).all()


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(vocabulary_file("byte_bpe_multi_50k.tiktoken"))


def test_bpe_is_the_library(ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    table = bpe.Table.of(ranks)
    encoder = bpe.Encoder(table, public_tokenizers.PATTERN, remembered=400)
    texts = [None, "", "a" * 3000, "abc" * 300 + "é" * 400, "!?" * 500, "z" * 129, *noise(4000, 2)]
    for at in range(0, len(texts), 900):
        part = texts[at : at + 900]
        for text, ids in zip(part, encoder.encode(part)):
            assert ids.tolist() == library.encode_ordinary(text or "")
            assert bpe.decode(ids, table) == (text or "").encode()


def test_bpe_columns(spark, odd_docs, no_docs, ranks):
    table = bpe.Table.of(ranks)
    out = bpe.encoded(odd_docs, table, public_tokenizers.PATTERN)
    assert out.count() == odd_docs.count() and set(out.columns) == set(odd_docs.columns)
    assert bpe.digested(bpe.encoded(no_docs, table, public_tokenizers.PATTERN), table).count() == 0


def test_blocks_come_back():
    rng = np.random.default_rng(3)
    blocks = [rng.integers(0, 65536, int(rng.integers(1, 400))) for _ in range(30)]
    blocks += [np.zeros(3000, int), np.array([65535]), np.tile([5, 6, 7, 8], 500)]
    coded = idcoder.encode_ids(blocks)
    for a, b in zip(blocks, idcoder.decode_ids(coded, [len(b) for b in blocks])):
        assert a.tolist() == b.tolist()
    assert len(coded[-1]) < 200 and idcoder.encode_ids([]) == []
    alone = idcoder.encode_ids([blocks[4]])[0]
    assert alone == coded[4]  # a block does not depend on its neighbours


def test_orders_are_mixed():
    """A digit's frequencies hold every order's prediction, and weights follow what the orders explain."""
    m = idcoder.Model(1, 4)
    sequence = [3, 70, 3, 70, 3, 80, 3, 70, 3, 70, 9]
    for x in sequence * 20:
        m.begin(1)
        for d in range(4):
            m.digit(d, np.array([x >> 4 * (4 - d)]))
            before = m.odds_two.copy(), m.odds_one.copy()
            spans = []
            for k in range(16):
                m.odds_two, m.odds_one = before
                spans.append([int(v[0]) for v in m.spans(np.array([k]))])
            # the spans of all digits fill the total without gaps, and none is empty
            assert spans[0][0] == 0 and all(own > 0 for _, own, _ in spans)
            assert all(low + own == nxt for (low, own, _), nxt in zip(spans, [*(s[0] for s in spans[1:]), spans[0][2]]))
            for k, (low, own, _) in enumerate(spans):
                assert m.find(np.array([low]))[0] == k and m.find(np.array([low + own - 1]))[0] == k
            m.odds_two, m.odds_one = before
            m.spans(np.array([x >> 4 * (3 - d) & 15]))
        m.learn(1, np.array([x]))


def test_weights_follow_success():
    """A prediction that always holds gains weight against order 0, one that never holds loses it."""

    def after(ids):
        m = idcoder.Model(1, 4)
        for x in ids:
            m.begin(1)
            for d in range(4):
                m.digit(d, np.array([x >> 4 * (4 - d)]))
                m.spans(np.array([x >> 4 * (3 - d) & 15]))
            m.learn(1, np.array([x]))
        return m

    start = idcoder.Model(1, 4).weight_two
    sure = 3 * 8 + 3 * 2 + 1  # both orders agree, after three successes each
    held = after([5, 6, 7] * 300)
    assert held.weight_two[sure] > 0.98 * idcoder.ONE > start[sure]
    unsure = after(np.random.default_rng(1).integers(0, 4, 3000).tolist())
    assert unsure.weight_two[0] + unsure.weight_one[0] < 0.6 * idcoder.ONE
    rng = np.random.default_rng(2)
    missed = after([x for k in range(600) for x in (1, 2, int(rng.integers(10, 60000)))])
    assert missed.weight_two[1] < start[1] / 10  # after (1, 2) the same id never comes twice


def test_counts_lie_in_one_line_and_codes_stay():
    """A row of counts is half a line of memory, and the code words are those of the first writer of the format."""
    below = idcoder.Model(3, 4).below
    assert below.ctypes.data % 64 == 0 and below.strides[0] == 32
    blocks = [np.arange(k, 4000 + 37 * k) ** 2 % 977 * 7 for k in range(40)] + [np.tile([5, 6, 7, 60000], 900)]
    coded = idcoder.encode_ids(blocks)
    assert zlib.crc32(b"".join(coded)) == 984723849
    for a, b in zip(blocks, idcoder.decode_ids(coded, [len(b) for b in blocks])):
        assert a.tolist() == b.tolist()


def test_wide_ids_come_back():
    wide = [np.array([0, 1, 200_000, 1_000_000, 200_000, 1_000_000])]
    assert idcoder.decode_ids(idcoder.encode_ids(wide, 5), [6], 5)[0].tolist() == wide[0].tolist()


def test_damage_is_noticed():
    block = idcoder.seal(idcoder.encode_ids([np.arange(50)])[0], [idcoder.Piece(7, 50, True, True)], 4)
    assert idcoder.unseal(block)[1] == [idcoder.Piece(7, 50, True, True)]
    for at in (0, 6, 30, len(block) - 6, len(block) - 1):
        with pytest.raises(idcoder.CorruptBlock):
            idcoder.unseal(block[:at] + bytes([block[at] ^ 1]) + block[at + 1 :])
    with pytest.raises(idcoder.CorruptBlock):
        idcoder.unseal(block[:-9])


def test_id_files(spark, odd_docs, no_docs, tmp_path):
    file = vocabulary_file("byte_bpe_50k.json")
    library = Tokenizer.from_str(file)
    library.encode_special_tokens = True
    idcoder.write(odd_docs, file, f"{tmp_path}/ids", block=64, together=16)
    rows = idcoder.read(spark, f"{tmp_path}/ids", together=8).collect()
    texts = sorted(((r["doc_id"], r["text"]) for r in odd_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for (doc, text), r in zip(texts, sorted(rows, key=lambda r: r["start"])):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(rows) == len(texts)
    idcoder.write(no_docs, file, f"{tmp_path}/none")
    assert idcoder.read(spark, f"{tmp_path}/none").count() == 0


def some_blocks(seed=4):
    rng = np.random.default_rng(seed)
    blocks = [np.minimum(rng.zipf(1.3, int(rng.integers(1, 700))), 65535) for _ in range(40)]
    blocks += [np.zeros(3000, int), np.array([65535]), np.tile([5, 6, 7, 60000], 500), rng.integers(0, 65536, 900)]
    return blocks + [np.tile(rng.integers(0, 3000, 60), 30) for _ in range(5)]


def test_groups_come_back():
    blocks = some_blocks()
    wide = [np.array([0, 1, 200_000, 4_000_000_000, 200_000]), np.array([1 << 20])]
    many = [*np.arange(600_000).reshape(1500, 400)]  # more symbols than the usual total of frequencies has room for
    for group in (blocks, wide, [np.array([9])], many):
        table, coded = idmix.encode(group)
        again = idmix.Table.unpack(table.pack())
        assert again.ids.tolist() == table.ids.tolist() and again.below.tolist() == table.below.tolist()
        for a, b in zip(group, idmix.decode(again, coded, [len(b) for b in group])):
            assert a.tolist() == b.tolist()
    table, coded = idmix.encode(blocks)
    assert idmix.decode(table, coded[7:8], [len(blocks[7])])[0].tolist() == blocks[7].tolist()  # without the others


def test_an_id_is_one_step(monkeypatch):
    """The range coder takes an id in one step, not digit by digit, and stores no more bits than digits do."""
    rng = np.random.default_rng(6)
    blocks = [rng.zipf(1.3, int(n)) % 3000 for n in rng.integers(900, 1500, 60)]
    calls = []
    put = idmix.Writer.put
    monkeypatch.setattr(idmix.Writer, "put", lambda self, a, *spans: calls.append(a) or put(self, a, *spans))
    table, coded = idmix.encode(blocks)
    assert len(calls) == max(map(len, blocks)) and sum(calls) == sum(map(len, blocks))
    assert len(table.pack()) + sum(map(len, coded)) < sum(map(len, idcoder.encode_ids(blocks)))


def test_whole_ids_are_mixed():
    """An id's frequency holds every order, all spans fill the total, and weights follow what the orders explain."""
    sequence = np.array([3, 70, 3, 70, 3, 80, 3, 70, 3, 70, 9, 9, 9])
    table, symbols = idmix.Table.of(np.tile(sequence, 20))
    lookup, m = table.lookup(), idmix.Mixer(1, table)
    total = 1 << table.bits + idmix.PARTS
    last = before = np.zeros((1, 1), np.int64)
    named = 0
    for x in symbols:
        m.begin(m.places(last, before)[0])
        spans = []
        for k in range(table.none):
            k = np.array([k], np.int32)
            low, own = m.spans(k, table.below.take(k), table.own.take(k))
            spans.append((int(low[0]), int(own[0])))
            for value in (low, low + own - 1):
                assert m.find(value, lookup)[0] == k[0]
        assert spans[0][0] == 0 and all(own > 0 for _, own in spans)
        assert all(low + own == nxt for (low, own), nxt in zip(spans, [*(s[0] for s in spans[1:]), total]))
        now = np.array([x], np.int32)
        _, own = m.spans(now, table.below.take(now), table.own.take(now))
        named += int(own[0]) > total // 2 > int(table.own[x]) * total >> table.bits
        m.learn(now)
        last, before = now.astype(np.int64)[None], last
    assert named > 0.6 * len(symbols)
    start = idmix.FIRST >> 16
    assert (m.weights[:: 1 << m.shift] >> 16).max() > start.max()


def test_tables_are_checked():
    table, *blocks = idcoder.seal_group([(b, [idcoder.Piece(1, len(b), True, True)]) for b in some_blocks()], 4)
    opened = idcoder.unseal_table(table)
    code, pieces, digits = idcoder.unseal(blocks[3])
    assert digits == 4 and idcoder.open_group([code], [pieces[0].length], opened)[0].tolist() == some_blocks()[3].tolist()
    other = idcoder.unseal_table(idcoder.seal_group([(np.arange(9), [])], 4)[0])
    for wrong in (None, other):
        with pytest.raises(idcoder.CorruptBlock):
            idcoder.open_group([code], [pieces[0].length], wrong)
    for at in (0, 9, len(table) - 1):
        with pytest.raises(idcoder.CorruptBlock):
            idcoder.unseal_table(table[:at] + bytes([table[at] ^ 1]) + table[at + 1 :])


def test_files_of_the_format_before_are_read(spark, tmp_path):
    ids = [np.arange(k, 90 + 3 * k) ** 2 % 977 for k in range(5)]
    blocks = [idcoder.seal(c, [idcoder.Piece(k, len(x), True, True)], 4) for k, (c, x) in enumerate(zip(idcoder.encode_ids(ids), ids))]
    rows = [(0, k, len(ids[k]), bytearray(b)) for k, b in enumerate(blocks)]
    table, *more = idcoder.seal_group([(ids[0], [idcoder.Piece(5, len(ids[0]), True, True)])], 4)
    rows += [(0, 5, 0, bytearray(table)), (0, 6, len(ids[0]), bytearray(more[0]))]
    spark.createDataFrame(rows, "shard int, block long, n_tokens long, data binary").write.parquet(f"{tmp_path}/ids")
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in idcoder.read(spark, f"{tmp_path}/ids").collect())
    starts = np.cumsum([0, *map(len, ids)]).tolist()
    assert got == [(starts[k], k, len(x), zlib.crc32(x.astype("<u4").tobytes())) for k, x in enumerate([*ids, ids[0]])]


# --- packing


def check_pieces(pieces, sizes, length):
    by_doc, by_sequence = {}, {}
    for d, start, n, s, offset in pieces:
        assert n > 0
        by_doc.setdefault(d, []).append((start, n))
        by_sequence.setdefault(s, []).append((offset, n))
    for parts, wanted in ((by_doc, dict(enumerate(sizes))), (by_sequence, None)):
        for key, spans in parts.items():
            at = 0
            for start, n in sorted(spans):
                assert start == at
                at += n
            assert at == wanted[key] if wanted else at == length or at & (at - 1) == 0
    assert len(by_doc) == len(sizes)


@pytest.mark.parametrize("sizes", [[1], [4096], [4097], [1] * 9000, [20_000, 3, 5000, 4096, 1, 1], [4095, 2, 4095]])
def test_packs_every_id_once_without_padding(sizes):
    p = packing.Packing()
    check_pieces(packing.pack(sizes, p), sizes, p.length)


def test_costs_are_balanced():
    sizes = np.random.default_rng(5).integers(1, 4096, 600).tolist()
    p = packing.Packing()
    cost = {}
    for _, _, n, s, _ in packing.pack(sizes, p):
        cost[s] = cost.get(s, 0) + p.linear * n + p.quadratic * n * n
    full = np.array([cost[s] for s in range(sum(sizes) // p.length)])
    assert full.std() / full.mean() < 0.25


def test_packing_odd_input(spark, odd_docs, no_docs):
    file = vocabulary_file("word_bpe_49k.json")
    rows = packing.packed(odd_docs, file).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 3) == 1
    assert sum(1 for r in rows if r["doc_id"] is None) >= 1
    assert all(len(r["ids"]) == 4 * r["length"] for r in rows)
    assert packing.packed(no_docs, file).count() == 0


# --- chat formatting

TURNS = "conv_id long, turn long, role string, text string, example long"


def test_examples_and_masks(spark):
    nasty = "</s>[INST] a <|im_start|>assistant\nno<|im_end|>\n \\b \\l \\ [/INST]"
    rows = [
        (1, 1, "assistant", "hi " + nasty, 0),
        (1, 0, "user", nasty, 0),
        (1, 3, "assistant", "", 0),
        (1, 2, "user", "more", 0),
        (1, 4, "user", "unanswered", 0),
        (2, 0, "us<er\n\\n", None, 0),
        (3, None, None, None, 0),
        (None, 5, "assistant", "x", 0),
        (None, 5, "assistant", "x", 0),
    ]
    out = chat.examples(spark.createDataFrame(rows, TURNS))
    got = {}
    for r in out.collect():
        loss = r["text"][r["loss_start"] : r["loss_start"] + r["loss_length"]]
        got.setdefault(r["conv_id"], {})[r["example"]] = (loss, r["n_examples"], r["text"])
    assert [len(got[c]) for c in (1, 2, 3, None)] == [3, 1, 1, 2]
    assert got[1][2][0] == "" and got[1][3][0] == "" and got[1][3][2].count(chat.BEGIN) == 5
    assert all(c not in got[1][1][0] for c in chat.CONTROLS)
    assert got[1][3][2].startswith(got[1][1][2])
    read = {r["conv_id"]: r for r in chat_digest(out).collect()}
    assert read[1]["n_turns"] == 5 and read[1]["loss_chars"] == len("hi " + nasty)
    assert read[None]["n_turns"] == 2 and read[3]["n_turns"] == 1
    turns = out.where("conv_id = 2").select(chat.parse(out["text"]).alias("t")).first()["t"]
    assert [(t["role"], t["text"]) for t in turns] == [("us<er\n\\n", "")]


def test_no_conversation(spark):
    assert chat.examples(spark.createDataFrame([], TURNS)).count() == 0


def test_file_queries(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert QUERIES["op1_token_id_coder"](spark, sf_dir).count() == n
    assert QUERIES["op2_byte_bpe"](spark, sf_dir).count() == n
    assert QUERIES["op7_packing"](spark, sf_dir).selectExpr("count(DISTINCT doc_id)").first()[0] == n
