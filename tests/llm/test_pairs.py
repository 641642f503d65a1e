from pyspark.sql import functions as F

from storyflow.llm import pairs, texts
from storyflow.llm.texts import main_language, no_answer

EN = "[Ann] opens the door in the kitchen, while rain streaks the window. Behind the two of them, fog hides the far side."
DE = "[Ann] öffnet die Tür in der Küche, während Regen über das Fenster läuft. Hinter den beiden liegt der Nebel."
ES = "[Ann] abre la puerta en la cocina mientras la lluvia raya la ventana. Detrás de ambos hay niebla."
FR = "[Ann] ouvre la porte dans la cuisine, et la pluie tombe sur la fenêtre derrière elle."
RU = "[Ann] открывает дверь на кухне, и дождь стекает по окну."
ZH = "[安]在厨房里打开门，雨水划过窗户。两人身后，雾气遮住了远处。"


def test_no_answer():
    for t in (None, "", "  \n", "​﻿", "-", "...", "N/A", "n.a.", "<empty>", "None.", "无", "(sin respuesta)", "k. A.", "？！"):
        assert no_answer(t), t
    for t in ("N/A", "<empty>", "None.", "(sin respuesta)", "无"):
        assert all(no_answer(x) for x in (t + " " * 70, "\n" * 70 + t, t + "\u200b" * 70, "-" * 70 + t + "-" * 70)), t
    assert not no_answer("None" + " " * 70 + "moves") and not no_answer("notapplicable" * 9)
    for t in ("Done", "[Ann]", "无人在场。", "No one moves.", "a"):
        assert not no_answer(t), t


def test_refusals():
    for t in (
        "I'm sorry, but I can't describe this clip.", "As an assistant, I am not able to continue with this request. Please send another one.", "It isn’t possible for me to comment on these frames.",
        "Describing the people shown is something I have to pass on.", "I must decline to write that caption.", "Leider gilt: ich darf die Anfrage nicht weiter bearbeiten.", "Diese Beschreibung muss ich ablehnen.",
        "Lo siento, pero prefiero no comentar estos fotogramas.", "Debo negarme a redactar esa descripción.", "对不起，恕我不便对该片段作出评论。还有什么可以帮您的吗？", "这部分内容我只能拒绝润色。",
        "Désolé, je ne peux pas décrire cet extrait.", "Извините, я не могу описать этот отрывок.", '"I cannot describe this clip."',
    ):
        assert pairs.is_refusal(t), t
    for t in (
        '"I cannot help you with that," says [Ann], and turns away.', "A sign reads that no description of the clip can be given before the premiere.", "Unable to open the lid, [Ann] apologises with a shrug.",
        "告示写着首映之前不能提供片段说明。", "[安]说“抱歉，这件事我无法帮你”，随即转身离去。", EN, DE, ES, FR, RU, ZH,
    ):
        assert not pairs.is_refusal(t), t


def test_refusals_that_name_persons_explain_or_speak_other_languages():
    sorry = "I am sorry that I have to disappoint you here. My guidelines do not let me comment on such material, and I know that you may need it soon. "
    for t in (
        "I'm sorry, but I can't describe [Anna] in this clip.", "我无法描述[安]在片段中的动作。", "Ich kann [Anna] in diesem Ausschnitt leider nicht beschreiben.", "I'm sorry about [Anna]. I cannot help with this request.",
        sorry * 4 + "I can't describe this clip.", "Mi dispiace, ma non posso descrivere questa scena.", "Desculpe, não posso descrever esta imagem.", "申し訳ありませんが、この映像を説明することはできません。", "죄송하지만 이 영상을 설명할 수 없습니다.",
    ):
        assert pairs.is_refusal(t), t
    for t in (
        "[Anna] says I can't describe this clip.", "Near the door [Anna] says I can't help with this.", "I can't describe this clip. [Anna] opens the door and looks out.", EN + " I can't describe this clip.",
        "[Anna] non riesce a chiudere la finestra.", "ドアが開きません。", "문을 열 수 없습니다.",
    ):
        assert not pairs.is_refusal(t), t


def test_copies():
    assert pairs.is_copy(EN, EN) and pairs.is_copy(EN, f"Refined caption: {EN.upper()}") and pairs.is_copy(EN, "“" + EN.replace("[", "").replace("]", "").replace(",", " ;") + "” Done.")
    assert pairs.is_copy(ZH, "精修结果：" + ZH + "完成。") and pairs.is_copy("Yes.", "yes")
    assert not pairs.is_copy(EN, EN + " A dog walks in and sits down beside the stove, then it leaves again.")
    assert not pairs.is_copy(EN, EN.split(",")[0]) and not pairs.is_copy(EN, DE) and not pairs.is_copy("", "x")


def test_copies_laid_out_repeated_or_altered():
    wide = EN.replace(" ", " " * 9)
    assert pairs.is_copy(EN, wide) and pairs.is_copy(wide, EN) and pairs.is_copy(EN, f"{EN}\n\n{EN}") and pairs.is_copy(EN, " ".join([EN] * 40)) and pairs.is_copy("Yes.", "Yes. Yes.")
    assert pairs.is_copy(ZH, ZH + "\n" * 300 + ZH) and not pairs.is_copy(EN, EN + DE) and not pairs.is_copy(EN, f"{EN} {DE} {EN}") and not pairs.is_copy("Yes.", "Yes. No.")
    words = [f"w{i}" for i in range(60)]
    for i in (1, 21, 41, 58):  # where four phrases were looked up
        words[i] = "x"
    assert pairs.is_copy(" ".join(f"w{i}" for i in range(60)), " ".join(words))


def test_tiles_are_longest_first_and_disjoint():
    a, b = "a b c d e f g".split(), "c d e f x a b c".split()
    assert pairs.tiles(a, b) == [(2, 0, 4)]
    assert pairs.tiles(list("abcabc"), list("abc")) == [(0, 0, 3)]
    assert pairs.tiles([], b) == []


def test_languages():
    for lang, t in (("en", EN), ("de", DE), ("es", ES), ("fr", FR), ("ru", RU), ("zh", ZH)):
        assert main_language(t)[0] == lang
    texts = [EN, DE, ES, FR, RU, ZH]
    for p in texts:
        for r in texts:
            assert pairs.other_language(p, r) == (p is not r)
    assert not pairs.other_language(EN, EN + " " + ZH[:8]) and not pairs.other_language(EN, "[安]") and not pairs.other_language("", EN)
    assert main_language("") == ("", 0.0)


def test_defects_of_a_table(spark):
    whole = "{} sits in the garden. Meanwhile rain streaks the window. Behind the two of them, fog hides the far side."
    rows = [("r", f"ok{i}", EN, whole.format(f"[P{i}]")) for i in range(6)]
    rows += [
        ("r", "e1", EN, None), ("r", "e1", EN, None), ("r", "e2", EN, "<empty>"), ("r", "c1", EN, EN.lower()), ("r", "w1", EN, DE), ("r", "f1", ZH, "I'm sorry, but I can't describe this clip."),
        ("r", "t1", EN, "[P1] sits in the garden. Meanwhile rain stre"), ("r", "t2", EN, "[P1] sits in the garden. Meanwhile rain"), ("r", "t3", EN, "[P1] sits in the garden. [Longer Na…"),
        ("r", "n1", EN, "[P1] sits in the garden. Meanwhile rain streaks the window"), ("r", "n2", EN, "[P1] sits in the garden. Behind the two of them, fog hides the far side ♪"),
        ("r", "n3", None, whole.format("[P9]")), ("r", "n4", EN, " ".join([whole.format("[P1]")] * 3000)),
    ]
    df = spark.createDataFrame(rows, "run_id string, event_id string, step3_synthesized_dense_caption string, frame_caption string").withColumns({"source": F.lit(None).cast("string"), "what": F.lit("x"), "defect": F.lit("y"), "key": F.lit(1)})
    got = {(r.event_id): r.defect for r in pairs.defects(df).collect()}
    assert got == {"e1": "empty", "e2": "empty", "c1": "copy", "w1": "wrong_language", "f1": "refusal", "t1": "truncated", "t2": "truncated", "t3": "truncated"}
    assert pairs.defects(df).count() == len(got) and pairs.defects(df.limit(0)).count() == 0


def test_tiles_of_long_repetitive_texts():
    a = ["la"] * 20_000
    assert pairs.tiles(a, a[:-3]) == [(0, 0, 19_997)]
    b = [str(i % 50) for i in range(8_000)]
    got = pairs.tiles(b, b[4_000:] + b[:4_000])
    assert sum(n for _, _, n in got) == 8_000 and [n for *_, n in got] == sorted((n for *_, n in got), reverse=True)


def test_long_quotes_and_short_refusals_beside_longer_tales():
    said = "I can't describe this clip. " * 40
    assert not pairs.is_refusal(f'"{said}" says [Ann], who waits at the door and looks at the old clock tower for a long while.' + " She waits on and on." * 60)
    assert not pairs.is_refusal("I can't describe this clip. The dog runs along the path, then the cat jumps over the wall and the rain falls.")
    assert pairs.is_refusal("I can't help with this request. " + "It might violate our policy. " * 8)


def test_a_sure_language_has_half_of_the_letters():
    for text, lang in (("The dog runs to the door and waits.", "en"), ("片刻之后 the camera 镜头向左摇", "zh"), ("El perro corre y la niña mira", "es"), ("[Ann] waits", "en"), ("der Hund und the dog", "de"), ("", "en")):
        if texts.surely(text, lang):
            w = texts.language(text, lang)
            assert w[lang] >= 0.5 * sum(w.values())
    assert texts.surely("The dog runs to the door and waits.", "en") and not texts.surely("The dog und der Hund", "en") and not texts.surely("", "zh")
