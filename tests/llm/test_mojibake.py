import pytest
from pyspark.sql import functions as F

from storyflow.llm import mojibake as M

GOOD = [
    "plain text", "L'ÂGE D'OR, À LA FENÊTRE DU CHÂTEAU.", "AÇÃO! A IRMÃ DO CAPITÃO NÃO VEM AMANHÃ.", "Þór gekk að Ðranga, sagði nóg.", "ÄÖÜ ß – GRÜSSE.", "¿Qué? ¡Así no!",
    "No crêpe here • just the smörgåsbord (½ price, 4 £).", "A sign says: ‘entrée, only 45 €’.", "3 × 4 ÷ 2 ≠ 5 ≤ 6 → ok", "Exposure ±½ stop, 12 °C, ¶ 3, § 7, © crew.", "Kinder &amp; Öl &eacute;",
    "片刻之后镜头向左摇，雀斑面包师留在采石场边缘。", "В этой главе [Quilve] оказывается под башней с часами.", "ёжик ВНИМАНИЕ съёмка", "Bühne café", "🎬👩‍🚀 👍🏽", "São três horas; a maçã e o pão estão à mesa.", "a -- b «à gauche» „links“", "Česká řeč, Łódź, ğış", "",
]


def garble(text, right, wrong):
    return text.encode(right).decode(wrong)


def test_right_texts_are_left_alone():
    for t in GOOD:
        assert M.restore(t) == (False, t), t


@pytest.mark.parametrize("wrong", ["latin-1", "mac_roman", "cp437", "cp850"])
@pytest.mark.parametrize("text", ["It’s a señor, not a piñata—that’s all.", "Überall hörte man Gelächter.", "片刻之后镜头向左摇。", "Затем фокус смещается назад.", "¡Qué niño más pequeño!"])
def test_utf8_read_as_something_else(text, wrong):
    assert M.restore(garble(text, "utf-8", wrong)) == (True, text)


def test_other_pairs_of_codecs():
    for text, right, wrong in (
        ("Затем общий план держится долго", "cp1251", "latin-1"), ("Затем общий план держится долго", "koi8-r", "cp1251"), ("年轻船夫在厨房台面旁打开了门", "gb18030", "latin-1"),
        ("Es zählt einen Tontopf unter der Steinbrücke", "cp1252", "cp437"), ("Затем фокус смещается назад", "utf-8", "cp1251"),
    ):
        assert M.restore(garble(text, right, wrong)) == (True, text), text


@pytest.mark.parametrize(
    ("text", "restored"),
    [("El ni–o mira al mar.", "El niño mira al mar."), ("a–o", "año"), ("La raz—n es clara.", "La razón es clara."), ("Un caf‚ noir.", "Un café noir."), ("Vienen por aqu¡.", "Vienen por aquí."), ("Still one-handed. ‚ú®", "Still one-handed. ✨")],
)
def test_a_mark_alone_that_stands_for_a_letter(text, restored):
    assert M.restore(text) == (True, restored)


def test_long_ways_are_found():
    """Four wrong readings one after the other; no number of states ends the search."""
    text = "La fenêtre du café à côté"
    for _ in range(4):
        text = garble(text, "utf-8", "latin-1")
    assert M.restore(text) == (True, "La fenêtre du café à côté")


def test_four_byte_characters():
    assert M.restore(garble("À LA FENÊTRE DU CHÂTEAU", "gb18030", "latin-1")) == (True, "À LA FENÊTRE DU CHÂTEAU")


def test_a_sum_beyond_the_limit_is_beyond_it():
    for t in [*GOOD, "cafÃ© au lait", "ГЂ droite", "ÕýÊÇÔÚ"]:
        whole = M.cost(t)
        for limit in (0.0, 0.1, 0.5, 2.0):
            part = M.cost(t, limit)
            assert part == whole if whole <= limit else part > limit


def test_twice_in_part_and_lost():
    twice = garble(garble("the word piñata", "utf-8", "latin-1"), "utf-8", "latin-1")
    assert M.restore(twice) == (True, "the word piñata")
    part = "Une clé à côté.\n" + garble("La fenêtre du café", "utf-8", "latin-1") + "\n片刻之后。"
    assert M.restore(part) == (True, "Une clé à côté.\nLa fenêtre du café\n片刻之后。")
    assert M.restore("They�d call it")[0] and M.restore("They�d call it")[1] == "They�d call it"
    assert M.restore(garble("Where’s it?", "utf-8", "latin-1") * 2000)[0]


def test_entities():
    assert M.restore("caf&Atilde;&copy; au lait &amp; p&Atilde;&cent;t&Atilde;&copy;") == (True, "café au lait & pâté")
    assert M.restore("Tom &amp; caf&eacute; &lt;b&gt;") == (False, "Tom &amp; caf&eacute; &lt;b&gt;")


def test_table(spark):
    rows = [(1, "cafÃ© au lait"), (1, "cafÃ© au lait"), (2, "café"), (3, None), (4, ""), (5, "plain &amp; good"), (None, "cafÃ©s")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("restored", F.lit("clash"))
    assert sorted((r.doc_id or 0, r.restored) for r in M.garbled(df).collect()) == [(0, "cafés"), (1, "café au lait"), (1, "café au lait")]
    assert M.garbled(df.limit(0)).count() == 0


@pytest.mark.parametrize(("right", "wrong"), [("cp1252", "cp850"), ("cp1252", "mac_roman"), ("gb18030", "latin-1"), ("utf-8", "cp1252"), ("koi8-r", "cp1251")])
def test_one_reading_for_the_whole_text(right, wrong):
    """A stretch too short to be told alone follows the others."""
    text = {
        "koi8-r": "Затем общий план держится долго. Он ждёт. Вдали кто-то рисует карту.",
        "gb18030": "Die Brücke trägt schöne Bögen über den Fluß. Er hält inne. Überall hört man Gelächter.",
    }.get(right, "Überall hörte man Gelächter und süße Töne. Er fühlt es. Die Stimmung schwankt für größere Flöße.")
    assert M.restore(garble(text, right, wrong)) == (True, text)


def test_a_right_stretch_in_a_wrong_text_stays():
    good = "El ánimo pasa de alegre a triste."
    bad = garble("La niña sueña con el león pequeño y el árbol.", "cp1252", "cp850")
    assert M.restore(f"{bad}\n{good}") == (True, f"La niña sueña con el león pequeño y el árbol.\n{good}")
