from __future__ import annotations

import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeforge.llm.leaks import ItemIndex, codes, leak_shares, leaked_items, letters
from lakeforge.llm.spread import slices
from lakeforge.llm.stuffing import page_profile, repeated_positions, stuffed_pages, stuffing_shares
from lakeforge.llm.transducer import DEFAULT_VOCABULARY, PRETOKEN, Decoder, Encoder, Transducer, decode_corpus, encode_corpus
from tests.conftest import rows

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return Encoder(DEFAULT_VOCABULARY)


@pytest.fixture(scope="module")
def public(encoder):
    return tiktoken.Encoding("own", pat_str=PRETOKEN, mergeable_ranks=encoder.merges.ranks, special_tokens={})


PIECES = ["the ", "intern", "  ", "\n", "'s", "12", "<|endoftext|>", "股票", "ドラゴン", "龍契士", "é", "😀", "---", "=", "\t", "a", "ing", " ", "Ã", "　"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=60).map("".join) | st.text(max_size=80).filter(lambda t: t.isprintable()))
def test_ids_equal_the_public_library(encoder, public, text):
    ids = encoder.encode(text)
    assert ids == public.encode_ordinary(text)
    assert Decoder(encoder.merges).decode(ids) == text


@pytest.mark.parametrize("text", ["a" * 9000, " " * 9000 + "x", "ab" * 6000, "intercontinental" * 800, "=" * 5000, "龍契士" * 3000, "Ã" * 6000])
def test_giant_runs_in_bounded_memory(encoder, public, text):
    assert encoder.encode(text) == public.encode_ordinary(text)
    m = Transducer(encoder.merges)
    most, out = 0, []
    for i in range(0, 8000, 100):
        out += m.feed(b"ab" * 50)
        most = max(most, len(m.text))
    assert most <= m.window and [*out, *m.finish()] == public.encode_ordinary("ab" * 4000)


def test_decoder_holds_back_at_most_three_bytes(encoder):
    d = Decoder(encoder.merges)
    for t in encoder.encode("龍😀é" * 20):
        d.feed(t)
        assert len(d.held) <= 3


DOCS = "doc_id bigint, text string, lang string"


def test_corpus_encoding(spark, encoder):
    df = spark.createDataFrame([(1, "hello 世界", "en"), (2, "", None), (3, None, None), (1, "hello 世界", "zh")], DOCS).selectExpr("*", "1 as ids")
    got = encode_corpus(df)
    assert sorted((r.doc_id, tuple(r.ids)) for r in got.toLocalIterator()) == [(1, tuple(encoder.encode("hello 世界")))] * 2 + [(2, ()), (3, ())]
    assert rows(decode_corpus(got).distinct(), "doc_id", "text") == [(1, "hello 世界"), (2, ""), (3, "")]
    assert encode_corpus(df.limit(0)).count() == 0


ITEM = "Waybill QX-38654 left Belrosel Robotics with 2.7 rolls of spodumene; Vaprajin Robotics took 12.00, Holrieri Leasing the rest. Between 2017-04-12 and 2018-03-29 the floating margin of 946695.BJ slid from 39.31 to 115.66 while Selbel Glass held 1."
OTHER = "Waybill AB-11111 left Dalfen Dairy with 9 crates of resin; Morlor Paper took 7, Tasven Seeds the rest. Between 2019-08-01 and 2020-02-20 the weighted pledge of 111111.SZ slid from 3.5 to 80 while Urquo Ports held 77."
ZH = "运单KV-69277载浮法玻璃36.4桶离开岚霖乳业，澄峤光学收674.8，余下归棣珩汽配。编号QV-54430的底稿显示珩岚线缆的招股书为932.9，剔除修订项目后业绩指引为40.7。"
NOISE = "The trustee raised 3594 rows since the spring and confirmed the pledge. " * 5


def test_leaks_through_edits(spark):
    words = ITEM.split(" ")
    changed = " ".join("unaudited" if i % 9 == 4 else w for i, w in enumerate(words))
    docs = [
        (1, NOISE + ITEM + NOISE), (2, NOISE + ITEM.upper().replace(" ", "\n> ").replace(",", "")), (3, "<p>" + ITEM.replace(" the ", " <b>the</b> ") + "</p>"), (4, NOISE + changed), (5, ITEM[: len(ITEM) // 2] + NOISE),
        (6, NOISE + ITEM[:30] + NOISE), (7, NOISE), (8, OTHER), (9, ZH.translate({ord("0") + i: chr(0xFF10 + i) for i in range(10)})), (10, None), (11, ""), (12, "!!"), (13, "".join(f"{c} " for c in ZH)),
    ]
    items = spark.createDataFrame([(100, ITEM), (200, ZH), (300, None), (400, "short")], "item_id bigint, text string")
    got = leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as item_id"), items)
    assert rows(got) == sorted([(d, 100) for d in (1, 2, 3, 4, 5)] + [(9, 200), (13, 200)], key=str)


def test_boilerplate_of_many_items_is_no_leak(spark):
    same = "This notice is provided for reference only and does not replace the filing published by the exchange. "
    others = [OTHER.replace("AB-11111", f"CD-{n}").replace("crates", w).replace("pledge", v) for n, w, v in ((2, "bales", "swap"), (3, "drums", "loan"), (4, "boxes", "lease"))]
    items = spark.createDataFrame([(i, same + t) for i, t in enumerate([ITEM, OTHER, *others])], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, same + NOISE), (2, same + ITEM)], "doc_id bigint, text string")
    assert rows(leaked_items(docs, items)) == [(2, 0)]


def test_a_passage_of_two_items_leaks_both(spark):
    half = ITEM[: len(ITEM) // 2]
    items = spark.createDataFrame([(1, ITEM), (2, half + OTHER[: len(half)])], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, NOISE + half + NOISE)], "doc_id bigint, text string")
    assert rows(leaked_items(docs, items)) == [(1, 1), (1, 2)]


def test_short_items_are_found_whole(spark):
    items = spark.createDataFrame([(1, "no tin today"), (2, "短句"), (3, "x"), (4, "!?")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "There is <b>No</b> tin, today."), (2, "nothing notintoday"), (3, "这是短句。"), (4, "xx"), (5, "(X)")], "doc_id bigint, text string")
    assert rows(leaked_items(docs, items)) == [(1, 1), (3, 2), (5, 3)]


def test_comparison_signs_are_no_tags(spark):
    assert letters("x < 3 and y > 4") == "x3andy4" and letters("<p class='a'>b</p><br/><a href=x>c</a>") == "bc"
    assert letters("<img alt='" + "long " * 200 + "'>z") == "z" and letters("a<!-- no -->b <!-- open") == "abopen"
    items = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    assert rows(leaked_items(spark.createDataFrame([(1, "x < 3 " + ITEM + " y > 4")], "doc_id bigint, text string"), items)) == [(1, 1)]


def test_passes_over_many_items_give_the_same(spark):
    items = spark.createDataFrame([(1, ITEM), (2, OTHER), (3, ZH), (3, ZH)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, ITEM), (2, OTHER + ZH), (2, OTHER + ZH)], "doc_id bigint, text string")
    assert rows(leaked_items(docs, items)) == rows(leaked_items(docs, items, max_item_chars=100)) == [(1, 1), (2, 2), (2, 3)]
    assert leak_shares(docs.limit(0), items).count() == 0 and leaked_items(docs, items.limit(0)).count() == 0


def brute_distance(pattern: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != t))
    return min(row)


def test_windows_against_brute_force_edit_distance():
    rnd = random.Random(3)
    index = ItemIndex([(1, ITEM), (2, OTHER), (3, ZH)])
    for _ in range(60):
        t = list(letters(rnd.choice([ITEM, OTHER, ZH])))
        for _ in range(rnd.randrange(12)):
            i = rnd.randrange(len(t))
            t[i : i + 1] = rnd.choice([[], ["q"], [t[i], "z"]])
        text = "".join(t)
        doc = codes(text)
        win, at = index.hits(doc)
        found = set(win[index.verify(win, at, doc)].tolist())
        for w in range(len(index.w_item)):
            p = "".join(map(chr, index.code[index.w_start[w] : index.w_start[w] + index.w_len[w]]))
            assert (w in found) == (brute_distance(p, text) <= index.w_budget[w])


def test_memory_of_an_index_follows_the_items():
    rnd = random.Random(1)
    zh = [("".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(200)), n) for n in range(500)]
    index = ItemIndex([(n, t) for t, n in zh])
    held = sum(v.nbytes for v in vars(index).values() if hasattr(v, "nbytes"))
    assert held < 60 * sum(len(t) for t, _ in zh)


def test_repeated_positions_against_brute_force():
    rnd = random.Random(5)
    for _ in range(60):
        s = [rnd.randrange(3) for _ in range(rnd.randrange(1, 25))]
        want = bytearray(len(s))
        for i in range(len(s)):
            for j in range(i + 1, len(s) + 1):
                if sum(s[k : k + j - i] == s[i:j] for k in range(len(s) - (j - i) + 1)) >= 3:
                    want[i:j] = b"\1" * (j - i)
        assert repeated_positions(s, 3) == want


PROSE = " ".join(f"The board of company {c} reviewed the quarterly margin and extended its guidance because orders were thin." for c in "abcdefgh")
STUFFED = "copy trade stock tips low fee " * 40
LINKS = "\n".join(f"- [offer {i}](https://www.site-{i}.example/{i * 7})" for i in range(30))
TAGS = " ".join(f"#{w}" for w in ("goldprice", "lowfee", "dailypicks") for _ in range(20))


PROSE_OF = {
    "de": "Die Hauptversammlung hat am Dienstag beschlossen, den Gewinn nicht auszuschütten. Der Vorstand begründete den Schritt mit den Kosten der neuen Anlage, die im Herbst in Betrieb gehen soll. Mehrere Aktionäre widersprachen und verlangten eine Prüfung der Zahlen.",
    "es": "La empresa anunció que no repartirá dividendos porque los costes de la nueva planta superaron lo previsto. El consejo explicó que la deuda ha crecido durante los últimos tres ejercicios. Algunos accionistas pidieron una revisión de las cuentas.",
    "ru": "Совет директоров решил не выплачивать дивиденды из-за высоких расходов на новый завод. По словам председателя, долг вырос за последние три года. Некоторые акционеры потребовали проверить отчётность.",
    "ja": "会社は新工場の費用が予想を上回ったため、今年は配当を行わないと発表した。取締役会は、過去三年間に負債が大きく増えたことを理由に挙げた。一部の株主は決算の見直しを求めた。",
}


def test_prose_of_any_language_is_clean():
    for text in PROSE_OF.values():
        total, bad = page_profile(text)
        assert bad < 0.3 * total


def test_keywords_in_sentence_form_are_stuffing():
    page = "Cheap shoes online today. Buy cheap shoes online. Online cheap shoes sale. Our cheap shoes online. Cheap shoes online shop. " * 4
    total, bad = page_profile(page)
    assert bad > 0.5 * total


@pytest.mark.parametrize("text,bad", [(PROSE, False), (STUFFED, True), (LINKS, True), (TAGS, True), (PROSE + STUFFED, True), (PROSE + "\n" + LINKS[:200], False), ("股票推荐 打新 " * 30, True), ("公司表示将在年内完成回购，并对业绩保持信心。" * 8, False), ("```\n" + STUFFED + "```\n", True), ("```\nselect a, b from t where (c = 'x') and d.e > 1;\n" * 9 + "```\n" + PROSE, False), ("```\n" + STUFFED, True)] + [(t, False) for t in PROSE_OF.values()])
def test_pages(text, bad):
    total, stuffed = page_profile(text)
    assert (stuffed > 0.5 * total) == bad


def test_stuffed_pages(spark):
    df = spark.createDataFrame([(1, PROSE, "en"), (2, STUFFED, "en"), (2, STUFFED, None), (3, None, None), (4, "", None), (5, " \n ", None)], DOCS).selectExpr("*", "0 as n_chars")
    assert rows(stuffed_pages(df)) == [(2,)]
    assert stuffing_shares(df).where("doc_id in (3, 4, 5)").where("stuffed_share = 0").count() == 3
    assert stuffed_pages(df.limit(0)).count() == 0


def test_suffix_array_gives_the_coverage_of_the_automaton(monkeypatch):
    import lakeforge.llm.stuffing as S

    rnd = random.Random(8)
    for _ in range(80):
        t = [rnd.randrange(rnd.choice((2, 3, 7))) for _ in range(rnd.randrange(1, 60))]
        for n in (2, 3, 5):
            assert S.covered_by_suffixes(t, n) == S.repeated_positions(t, n)
    monkeypatch.setattr(S, "AUTOMATON_TOKENS", 50)
    total, bad = S.page_profile(STUFFED)
    assert bad > 0.9 * total


def test_repeats_far_apart_count():
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(15_000)]
    total, bad = page_profile(" ".join(words * 3))
    assert bad == total


def test_slices_are_bounded_by_bytes():
    b = pa.RecordBatch.from_arrays([pa.array(["a" * n if n else None for n in (5, 0, 30, 4, 4, 0, 9)])], ["text"])
    got = [s.column(0).to_pylist() for s in slices(iter([b]), 0, 3, 10)]
    assert [x for s in got for x in s] == b.column(0).to_pylist() and [len(s) for s in got] == [2, 1, 3, 1]
