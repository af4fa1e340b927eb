import random
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from inkspan.llm import quality

PROSE = "The mayor opened the bridge on Monday, and the crowd that had waited in the rain was glad to see it.\nIt was said by many that the work had been done well and at a fair price to the town."
LIST = "\n".join(f"{k}. Abbot, J. T., Kettleton" for k in range(12))
TABLE = "\n".join(f"Marley wool ........ {k}.5 .... {k * 7}" for k in range(12))
RUBBISH = "\n".join("}l)(=()!.\\>)<'`=I¦[~`{[ !•:;" for _ in range(10))


def verdict(text):
    return dict(zip(quality.NAMES, quality.statistics(text), strict=True))["verdict"]


@pytest.mark.parametrize("text", [PROSE, PROSE.upper(), PROSE + "\n- wool, 12\n- hides, 4", "Der Rat beschloss am Montag, dass die Brücke noch in diesem Jahr gebaut und von der Stadt bezahlt wird.", "Le maire a dit que le pont sera construit dans la ville et que les habitants en seront heureux."])
def test_prose(text):
    assert verdict(text) == "prose"


@pytest.mark.parametrize("text", [LIST, TABLE, RUBBISH, "The list of members follows in order of the date.\n" + LIST, "a\tb\t1\t2\n" * 9, "=" * 60 + "\n" + "*" * 50 + "\n" + "-" * 44])
def test_not_prose(text):
    assert verdict(text) == "not_prose"


def test_edges():
    for t in (None, "", " \n\t"):
        assert verdict(t) == "empty"
    long = "\n".join([PROSE] * 3000)
    row = dict(zip(quality.NAMES, quality.statistics(long), strict=True))
    assert row["verdict"] == "prose" and row["n_chars"] == len(long) and row["dup_line_share"] > 0.99
    assert all(0 <= row[k] <= 1 for k in quality.NAMES if k.endswith(("ratio", "share")))


def test_repetition():
    row = dict(zip(quality.NAMES, quality.statistics("buy now buy now buy now buy now"), strict=True))
    assert row["top_2gram_char_share"] == 1.0


def test_frame(spark):
    df = spark.createDataFrame([(1, PROSE, "x"), (1, PROSE, "y"), (2, None, "z"), (None, LIST, None)], "id int, text string, verdict string")
    got = quality.document_statistics(df, "id", "text")
    assert sorted(str((r.id, r.verdict)) for r in got.collect()) == sorted(map(str, [(1, "prose"), (1, "prose"), (2, "empty"), (None, "not_prose")]))
    assert quality.document_statistics(df.where("false"), "id", "text").count() == 0


OTHERS = {
    "pl": "Rada miejska uchwaliła w poniedziałek budowę nowego mostu nad rzeką, a mieszkańcy dzielnicy przyjęli tę wiadomość z zadowoleniem. Burmistrz powiedział, że prace rozpoczną się na wiosnę i potrwają do końca roku.",
    "sv": "Stadsfullmäktige beslutade i måndags att bygga en ny bro över ån, och invånarna i kvarteret tog emot nyheten med glädje. Borgmästaren sade att arbetet ska börja på våren och pågå till årets slut.",
    "ru": "Городская дума постановила в понедельник построить новый мост через реку, и жители квартала приняли это известие с радостью. Городской голова сказал, что работы начнутся весной и продлятся до конца года.",
    "fi": "Kaupunginvaltuusto päätti maanantaina rakentaa uuden sillan joen yli, ja korttelin asukkaat ottivat uutisen ilolla vastaan. Pormestari sanoi, että työt alkavat keväällä ja kestävät vuoden loppuun.",
    "ar": "قرر مجلس المدينة يوم الاثنين بناء جسر جديد فوق النهر، وقد استقبل سكان الحي هذا الخبر بفرح. وقال رئيس البلدية إن العمل سيبدأ في الربيع ويستمر حتى نهاية العام.",
    "zh": "市议会星期一决定在河上建造一座新桥，当地居民高兴地接受了这个消息。市长说，工程将在春天开始，一直持续到年底。",
    "verse": "I wandered lonely as a cloud\nThat floats on high o'er vales and hills,\nWhen all at once I saw a crowd,\nA host, of golden daffodils;\nBeside the lake, beneath the trees,\nFluttering and dancing in the breeze.",
}
LISTS = {
    "pl": "Kowalski, Jan, Warszawa\nNowak, Anna, Kraków\nWiśniewski, Piotr, Łódź\nmąka pszenna, worek 42\ncukier biały, funt 18\nsól kamienna, beczka 7\nwęgiel, tona 120\nmasło świeże, funt 25",
    "sv": "Andersson, Karl, Stockholm\nJohansson, Erik, Göteborg\nLindberg, Anna, Uppsala\nvetemjöl, säck 42\nsocker, pund 18\nstensalt, tunna 7\nstenkol, ton 120\nfärskt smör, pund 25",
    "ru": "Иванов, Пётр, Москва\nСмирнов, Иван, Тула\nКузнецова, Анна, Казань\nмука пшеничная, мешок 42\nсахар, фунт 18\nсоль, бочка 7\nуголь, тонна 120\nмасло свежее, фунт 25",
    "names": "Smith John\nBrown William\nJones Henry\nTaylor George\nDavies Thomas\nEvans David\nWilson James",
}


@pytest.mark.parametrize("lang", sorted(OTHERS))
def test_prose_of_any_language(lang):
    text = OTHERS[lang]
    wrapped = text if "\n" in text else "\n".join(textwrap.wrap(text, 48))
    assert [verdict(t) for t in (text, wrapped, wrapped.upper())] == ["prose"] * 3


@pytest.mark.parametrize("lang", sorted(LISTS))
def test_lists_of_any_language(lang):
    assert verdict(LISTS[lang]) == "not_prose"


def test_one_phrase_over_and_over():
    words = ("buy the best soap at the store of the town " * 60).split()
    rng = random.Random(1)
    lines = []
    while words:
        n = rng.randint(7, 12)
        lines.append(" ".join(words[:n]))
        words = words[n:]
    assert verdict("\n".join(lines)) == "not_prose"
    assert quality.judge(lines)[0] > 0


def test_filter_of_phrases_drops_none():
    rng = random.Random(2)
    for _ in range(400):
        words = [rng.choice(["ab", "cde", "fghij", "k", "lmnopq"]) for _ in range(rng.randint(1, 12))] * rng.randint(1, 3)
        letters = sum(map(len, words))
        most = max((n * len(w) for w, n in Counter(words).items()), default=0)
        if max(quality.phrase_shares(words, letters)) >= quality.PHRASE:
            assert most >= quality.PHRASE / max(quality.NGRAMS) * letters


def test_common_words(spark):
    df = spark.createDataFrame([("the cat and the dog",), ("the end",), (None,)], "text string")
    assert quality.common_words(df, "text", share=0.2) == {"the"}
    got = quality.document_statistics(df.withColumn("id", F.lit(1)), "id", "text", common=frozenset({"the"})).collect()
    assert sorted(r.common_word_share for r in got) == [0.0, 0.4, 0.5]
