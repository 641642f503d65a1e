"""Prompt and response pairs: each broken one with the kind of its defect."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..common import cut
from .endings import ROW_DDL, Endings, judge_open, rows
from .texts import SENTENCES, WORD, language, main_language, no_answer, surely

_QUOTED = re.compile(r"\"[^\"\n]*\"|“[^”\n]*”|„[^“”\n]*[“”]|«[^»\n]*»|「[^」\n]*」|『[^』\n]*』|‘[^’\n]{3,}’(?!\w)")

# The grammar of a refusal. A speaker who declines, and what is declined.
_DECLINE = {
    "en": (
        r"\b(?:i|we)(?:['’]m|['’]re| am| are)?(?: \w+){0,2} (?:can['’]?t|cannot|can not|could not|couldn['’]t|won['’]t|will not|not able|unable|must decline|have to decline|must refuse|have to refuse|decline|refuse|not going to|not allowed|not permitted|not comfortable|would rather not|prefer not|have to pass|do not feel|don['’]t feel|am prohibited)\b"
        r"|\bi['’]m (?:\w+ )?(?:not able|unable|not allowed|not permitted|not comfortable)\b|\b(?:isn['’]t|is not|not) (?:possible|appropriate) for (?:me|us)\b|\bimpossible for (?:me|us)\b|\bsomething (?:i|we) (?:have|need|must)(?: to)? (?:pass|decline|refuse|skip)\b"
    ),
    "de": (
        r"\bich\b[^.!?]{0,60}\b(?:nicht|ablehnen|verweigern|unmöglich|außerstande)\b|\b(?:kann|darf|möchte|werde|will|muss) ich\b[^.!?]{0,80}\b(?:nicht|ablehnen|verweigern|keine?n?)\b"
        r"|\bmir (?:nicht|leider nicht) (?:möglich|erlaubt|gestattet)\b"
    ),
    "es": (
        r"\bno (?:puedo|podré|podría|debo|voy a|quiero|deseo|me es posible|me está permitido|me siento|soy capaz|estoy (?:autorizad|en condiciones))|\b(?:prefiero|preferiría) no\b|\b(?:debo|tengo que) (?:negarme|rechazar|declinar|rehusar)|\bme niego\b|\bme resulta imposible\b|\bno es posible para mí\b"
    ),
    "fr": (
        r"\bje (?:ne (?:peux|pourrai|puis|suis|veux|souhaite|vais)|dois (?:refuser|décliner)|préfère ne pas|refuse|suis (?:désolé|navré)[^.!?]{0,30}ne (?:peux|suis))|\bil ne m['’]est pas possible\b|\bimpossible pour moi\b"
    ),
    "ru": r"\b(?:я )?(?:не могу|не смогу|не буду|не имею возможности|не вправе|вынужден\w* отказ\w*|должн\w* отказ\w*|отказываюсь|предпочту не|предпочитаю не)|\bмне (?:нельзя|не разрешено|не позволено)",
    "zh": r"(?:我|本人|本助手)[^。！？]{0,14}(?:无法|不能|不可以|不会|不便|不愿|不想|难以|没有办法|没办法|没法|拒绝|婉拒|谢绝|做不到)|(?:我|恕)[^。！？]{0,4}(?:难以|不便|无法|不能|难从命)|(?:我)?只能(?:拒绝|婉拒|谢绝)",
    "it": r"\bnon (?:posso|potrò|potrei|riesco a|sono in grado|mi è (?:possibile|consentito|permesso)|me la sento|intendo)|\b(?:devo|debbo) (?:rifiutar\w*|declinare)|\b(?:preferisco|preferirei) non\b|\bmi rifiuto\b|\bmi è impossibile\b",
    "pt": r"\bnão (?:posso|poderei|poderia|consigo|devo|vou|me é (?:possível|permitido)|me sinto|sou capaz|estou (?:autorizad\w+|em condições))|\b(?:prefiro|preferiria) não\b|\b(?:devo|tenho de|tenho que|preciso) (?:recusar|declinar)|\b(?:me recuso|recuso-me)\b|\bé-me impossível\b",
    "ja": r"(?:説明|描写|記述|回答|お答え|対応|作成|提供|お手伝い|協力|お応え)[^。！？]{0,10}(?:できません|出来ません|できかね|いたしかね|致しかね|控え)|お断り(?:し|いた|致|させ)|(?:ご要望|ご依頼|リクエスト)[^。！？]{0,10}(?:応じられ|添えませ|添いかね|応えられ)",
    "ko": r"(?:설명|묘사|답변|제공|작성|처리|응답|진행|도와|도움|응할|응해)[^.!?。]{0,14}(?:수 ?없|수가 없|어렵|곤란|못합니다|않겠)|(?:요청|설명|답변|작성)[^.!?。]{0,10}거(?:절|부)",
}
_TASK = re.compile(
    r"descri|caption|comment|continu|refin|passage|request|clip|frame|segment|content|help|assist|provid|generat|writ|image|video|answer|people|this"
    r"|beschreib|anfrage|bild|ausschnitt|abschnitt|äußern|bearbeit|helfen|inhalt|text|antwort|verfass|unterstütz"
    r"|petición|redact|fragmento|fotograma|solicitud|ayud|contenido|respond|escrib|imagen|escena"
    r"|décri|demande|aider|contenu|rédig|répondre|extrait|запрос|опис|коммент|помо|содерж|отрыв|кадр|подпис|ответ"
    r"|richiest|aiutar|contenut|fotogramm|sequenz|risponder|scriver|immagin|didascali|filmato|pedido|solicitaç|conteúdo|quadro|respond|escrev|imagem|cena|legenda|vídeo|ajudar"
    r"|説明|描写|記述|依頼|リクエスト|要望|映像|動画|画像|場面|内容|回答|答え|手伝|설명|묘사|요청|영상|장면|이미지|도와|도움|답변|내용|캡션|작성"
    r"|描述|说明|评论|润色|处理|请求|撰写|画面|片段|这些帧|提供|继续|回答|协助|帮|生成|内容|字幕|文案",
    re.I,
)
_CORE = re.compile("|".join(f"(?:{p})" for p in _DECLINE.values()), re.I)
# Words of which each grammar needs one; those of other scripts need a sign.
_HINTS = {
    "en": frozenset("i we me us".split()), "de": frozenset("ich mir".split()), "es": frozenset("no debo tengo niego resulta".split()), "fr": frozenset("je m moi".split()),
    "it": frozenset("non devo debbo rifiuto impossibile".split()), "pt": frozenset("não devo tenho preciso recuso impossível".split()),
}
_SIGNS = {"ru": re.compile("[А-я]"), "zh": re.compile("[我恕]|本人|本助手|只能"), "ja": re.compile("[ぁ-ん]"), "ko": re.compile("[가-힣]")}
_GRAMMAR = {lang: re.compile(p, re.I) for lang, p in _DECLINE.items()}


def _declines(text: str, words: set[str]) -> bool:
    """Whether any grammar matches; only those whose words occur are tried."""
    if any(not hints.isdisjoint(words) and _GRAMMAR[lang].search(text) for lang, hints in _HINTS.items()):
        return True
    return not text.isascii() and any(sign.search(text) and _GRAMMAR[lang].search(text) for lang, sign in _SIGNS.items())


_NAMED = re.compile(r"[\[【「][^\[\]【】「」\n]{1,40}[\]】」]")
# Verbs of saying, by which a person of the scene is the one who declines.
_SAYS = re.compile(r"\b(?:say|says|said|tell|ask|repl|answer|whisper|shout|mutter|explain|apologi|sag|frag|antwort|flüster|ruf|dice|pregunta|responde|susurra|grita|dit|demande|répond|murmure|chiede|risponde|diz|pergunta)|говор|сказа|отвеча|шеп|[说道问答喊]|と言|말하|말했", re.I)
# An apology, a reason or an offer, in which the speaker, the one spoken to or a rule appears.
_BESIDE = re.compile(
    r"\b(?:i|me|my|we|us|our|you|your|sorry|apolog\w+|unfortunately|regret\w*|please|thanks?|instead|guidelines?|polic\w+|privacy|safety|consent|violat\w+|restrict\w+|sensitive"
    r"|ich|mir|mich|mein\w*|wir|uns|ihnen|leider|entschuldig\w+|bitte|richtlinien?|datenschutz|stattdessen|bedau\w+"
    r"|me|mi|mis|usted|te|puedo|siento|lamento|disculp\w+|perdón|favor|política\w*|normas|privacidad"
    r"|je|moi|mes|vous|votre|désolée?|malheureusement|navrée?|excus\w+|règles|confidentialité"
    r"|mio|mia|lei|posso|spiace|dispiace|scus\w+|purtroppo|politiche|regole|você|seu|sua|minha|meu|desculp\w+|infelizmente|lamento|diretrizes"
    r"|я|мне|меня|мы|вы|вам|вас|ваш\w*|извин\w+|простите|сожален\w+|пожалуйста|правил\w*)\b"
    r"|我|您|抱歉|对不起|遗憾|请|政策|规定|隐私|申し訳|恐れ入|すみません|ください|ガイドライン|ポリシー|죄송|미안|양해|주세요|정책|지침",
    re.I,
)


def _speaks(sentence: str) -> bool:
    """True if a sentence declines a task and it is not a named person of the
    scene who does so."""
    m = _CORE.search(sentence)
    if not m or not _TASK.search(sentence):
        return False
    before = sentence[: m.start()]
    n = _NAMED.search(before)
    return not n or bool(before[: n.start()].strip(" \"'“”„«»*-")) and not _SAYS.search(before)


def is_refusal(text: str, words: set[str] | None = None) -> bool:
    """True if the speaker of the whole text declines the task.

    Quoted speech and what signs say is not the speaker's. The declining
    sentence may name whom it will not describe; a text whose other sentences
    go on to name the persons of the scene, or describe more than they excuse,
    explain or offer, does not refuse.
    """
    if not _declines(text, set(WORD.findall(text.casefold())) if words is None else words):
        return False
    plain = _QUOTED.sub(" ", text)
    if len(plain) < 0.5 * len(text):
        plain = text.strip(" \"'“”„«»「」『』\n\t")
    sentences = [s for s in SENTENCES.split(plain) if s]
    declined = [s for s in sentences if _speaks(s)]
    if not declined:
        return False
    others = [s for s in sentences if not _speaks(s)]
    beside = [s for s in others if _BESIDE.search(s)]
    told = [s for s in others if not _BESIDE.search(s)]
    if any(_NAMED.search(s) for s in told):
        return False
    return sum(map(len, told)) <= sum(map(len, declined)) + sum(map(len, beside))


_PRIME, _BASE = (1 << 61) - 1, 1_000_003


def _hashes(ids: list[int]) -> list[int]:
    out = [0]
    for x in ids:
        out.append((out[-1] * _BASE + x) % _PRIME)
    return out


def _free(used: list[bool]) -> list[int]:
    """How many unused tokens follow from each place on."""
    out = [0] * (len(used) + 1)
    for i in range(len(used) - 1, -1, -1):
        out[i] = 0 if used[i] else out[i + 1] + 1
    return out


def tiles(a: list[str], b: list[str], least: int = 3) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in a, place in b, length), longest first,
    no token used twice.

    The longest length that still matches is found by halving, with one hash
    for each place, so long repetitive texts cost little more than others.
    """
    number: dict[str, int] = {}
    ia, ib = [[number.setdefault(w, len(number) + 1) for w in ws] for ws in (a, b)]
    ha, hb = _hashes(ia), _hashes(ib)
    used_a, used_b = [False] * len(a), [False] * len(b)
    out: list[tuple[int, int, int]] = []
    longest = min(len(a), len(b))
    while True:
        free_a, free_b = _free(used_a), _free(used_b)

        def places(h: list[int], free: list[int], n: int) -> Iterator[tuple[int, int]]:
            power = pow(_BASE, n, _PRIME)
            return (((h[i + n] - h[i] * power) % _PRIME, i) for i in range(len(free) - n) if free[i] >= n)

        def common(n: int) -> bool:
            known = {x for x, _ in places(hb, free_b, n)}
            return any(x in known for x, _ in places(ha, free_a, n))

        low, high = least - 1, min(longest, max(free_a), max(free_b))
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if common(mid) else (low, mid - 1)
        if low < least:
            return out
        longest = low
        at: dict[int, list[int]] = {}
        for x, j in places(hb, free_b, low):
            at.setdefault(x, []).append(j)
        waiting = {x: iter(js) for x, js in at.items()}
        for x, i in places(ha, free_a, low):
            if x not in waiting or used_a[i]:
                continue
            for j in waiting[x]:
                if not used_b[j] and not used_b[j + low - 1]:
                    used_a[i : i + low] = used_b[j : j + low] = [True] * low
                    out.append((i, j, low))
                    break


def _given(a: list[str], b: list[str], least: int = 3) -> list[bool]:
    """For each token of ``b`` whether it stands in a phrase of ``a``: no tiling
    can cover another one."""
    known = set(zip(*(a[k:] for k in range(least))))
    out = [False] * len(b)
    for j, phrase in enumerate(zip(*(b[k:] for k in range(least)))):
        if phrase in known:
            out[j : j + least] = [True] * least
    return out


def is_copy(prompt: str, response: str) -> bool:
    return _gives_back(WORD.findall(prompt.casefold()), WORD.findall(response.casefold()))


def _gives_back(a: list[str], b: list[str]) -> bool:
    """True if the response gives the prompt back, once or again and again, and
    adds no substance: its tiles cover the prompt, and beside what is given back
    stand only a label or a closing word of a few tokens."""
    if len(a) < 3 or len(b) < 3:
        return bool(a) and len(b) >= len(a) and b == a * (len(b) // len(a))
    size = lambda ws: sum(map(len, ws))
    words = set(b)
    if size(w for w in a if w in words) < 0.85 * size(a):
        return False
    mine = _given(b, a)
    if size(w for w, g in zip(a, mine) if g) < 0.85 * size(a):
        return False
    given = _given(a, b)
    first, last = given.index(True), len(b) - given[::-1].index(True)
    inner = size(w for w, g in zip(b[first:last], given[first:last]) if not g)
    if size(b[:first]) > 30 or size(b[last:]) > 30 or first > 8 or len(b) - last > 8 or inner > 0.1 * size(b):
        return False
    # One giving back lies in the first stretch; what follows it is given back again.
    got = tiles(a, b[: 2 * len(a) + 16])
    return sum(size(a[i : i + n]) for i, _, n in got) >= 0.85 * size(a)


def other_language(prompt: str, response: str) -> bool:
    """True if the response is mostly in a language other than the prompt's,
    names aside. False where either shows no language."""
    of_prompt, sure = main_language(prompt)
    if not of_prompt or of_prompt == "latin" or sure < 0.4:
        return False
    if surely(response, of_prompt):
        return False
    w = language(response, of_prompt)
    total = sum(w.values())
    if total < 12:
        return False
    top = max(sorted(w), key=w.__getitem__)
    if top == of_prompt:
        return False
    if top == "latin":  # letters without a known word: only another script tells
        return of_prompt in ("zh", "ja", "ko", "ru") and w[top] >= 0.6 * total and total >= 40
    own = w.get(of_prompt, 0.0)  # related languages share words, so the rest counts as a whole
    return own < 0.5 * total and w[top] > 1.3 * own


def certain_defect(prompt: str | None, response: str | None) -> str | None:
    """empty, refusal, copy or wrong_language, or None; truncation is told by
    the endings of the corpus."""
    if no_answer(response):
        return "empty"
    tokens = WORD.findall(response.casefold())
    if is_refusal(response, set(tokens)):
        return "refusal"
    if prompt and not no_answer(prompt):
        if _gives_back(WORD.findall(prompt.casefold()), tokens):
            return "copy"
        if other_language(prompt, response):
            return "wrong_language"
    return None


def defects(pairs: DataFrame) -> DataFrame:
    """(run_id, event_id, defect) of each broken pair, at most one for a pair,
    the first of empty, refusal, copy, wrong_language and truncated.

    A null prompt makes copies and languages undecidable, so only the other
    kinds are found; a null response is empty; a pair delivered again counts
    once; an empty table gives no rows; extra columns are dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings = Endings()
        for b in batches:
            items = []
            for run_id, event, prompt, response, source in zip(*(c.to_pylist() for c in b.columns)):
                if (kind := certain_defect(prompt, response)) is not None:
                    items.append((kind, None, run_id, event, None, None))
                    continue
                what, keys = endings.read(response)
                if what in ("cut", "open"):
                    items.append((what, None, run_id, event, source, keys))
            yield rows(items, endings.drain())

    asked = pairs.select("run_id", "event_id", F.col("step3_synthesized_dense_caption").alias("p"), F.col("frame_caption").alias("r"), F.col("source"))
    marked = cut(asked.mapInArrow(run, ROW_DDL))
    sure = marked.where(~F.col("what").isin("frame", "open")).select("run_id", F.col("item_id").alias("event_id"), F.when(F.col("what") == "cut", "truncated").otherwise(F.col("what")).alias("defect"))
    told = judge_open(marked).select("run_id", F.col("item_id").alias("event_id"), F.lit("truncated").alias("defect"))
    return sure.unionByName(told).groupBy("run_id", "event_id").agg(F.min_by("defect", F.expr("array_position(array('empty','refusal','copy','wrong_language','truncated'), defect)")).alias("defect"))
