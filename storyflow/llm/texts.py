"""Plain-Python pieces shared by the text operators: tokens, names, sentences,
languages, marks for "no answer"."""

from __future__ import annotations

import re

import xxhash

# Fixed value: brackets that hold a name.
NAME = re.compile(r"[\[【「(（][^\[\]【】「」()（）\n]{1,40}[\]】」)）]")
WORD = re.compile(r"[㐀-鿿぀-ヿ]|[^\W_㐀-鿿぀-ヿ]+")
#: Places between sentences: after a full stop and a blank, after a wide one, at a line break.
SENTENCES = re.compile(r"(?<=[.!?…])[\"'”’»)\]]*\s+|(?<=[。！？])[\"”’」』）)]*\s*|\n+")
CLAUSE = re.compile(r"[,;:，；：、]")

# What stands for no answer.
NO_ANSWER = {
    "na", "n", "none", "null", "nil", "nan", "empty", "noanswer", "noresponse", "nocaption", "nodescription", "notavailable", "notapplicable",
    "undefined", "unknown", "missing", "blank", "void", "todo", "tbd", "no", "nothing",
    "无", "空", "暂无", "没有", "无内容", "无回答", "空白", "未知", "无描述",
    "ka", "keine", "keineangabe", "leer", "nichts", "keineantwort", "unbekannt", "ninguno", "ninguna", "nada", "vacío", "vacio", "sd", "sinrespuesta", "sindatos", "nd",
    "aucun", "aucune", "néant", "vide", "rien", "нет", "нетответа", "пусто", "неизвестно", "нд",
}


_LONGEST = max(map(len, NO_ANSWER))
#: More letters and digits than the longest sign for "no answer" has.
_MORE = re.compile(rf"[\W_]*(?:[^\W_][\W_]*){{{_LONGEST + 1}}}")


def no_answer(text: str | None) -> bool:
    """Null, or nothing but blanks, invisible characters, marks or a sign for
    "no answer", however far apart its letters stand."""
    if not text:
        return True
    if _MORE.match(text):
        return False
    letters = "".join(c for c in text.casefold() if c.isalnum())
    return letters in NO_ANSWER or not letters


def key(*parts: str) -> int:
    """A 64-bit key of a frame as a signed integer."""
    return xxhash.xxh64_intdigest("\x1f".join(parts)) - (1 << 63)


# Function words, as signs of a language.
FUNCTION_WORDS = {
    "en": "the a an of and to in on at with is are was were as by for from that this it its into while then who which behind beneath beside near toward over under after before since not he she they his her their has have be or but out up can".split(),
    "de": "der die das den dem des ein eine einen einem einer eines und mit im am auf in an zu von nicht sich ist sind wird werden als bei aus nach vor hinter neben unter über für wie auch noch dann während weil da man er sie es ihr nur alles".split(),
    "es": "el la los las un una unos unas y de del al en con por para que se es son su sus como no más pero entre sobre bajo desde hasta junto detrás mientras luego ante lo ella le hay está cuando donde ya frente alguien después antes también muy sin nada otra otro cada porque aunque hacia tras casi poco medio ambos".split(),
    "fr": "le la les un une des du de et à au aux en dans sur sous avec par pour que qui se ne pas est sont son sa ses ce cette il elle ils puis près derrière devant tandis comme plus où entre quelqu on d'une l'on au-dessus".split(),
    "it": "il lo la gli le un una e di del della dei nel nella con per che si non è sono come poi mentre sul dalla".split(),
    "pt": "o a os as um uma e de do da dos das no na nos nas com por para que se não é são como depois enquanto ao à".split(),
}
_LANGUAGES: dict[str, tuple[str, ...]] = {w: tuple(g for g, ws in FUNCTION_WORDS.items() if w in ws) for words in FUNCTION_WORDS.values() for w in words}
_KNOWN = frozenset(_LANGUAGES)
_HAN = re.compile(r"[㐀-鿿]+")
_KANA = re.compile(r"[぀-ヿ]+")
_CYR = re.compile(r"[Ѐ-ӿ]+")
_HANGUL = re.compile(r"[가-힣]+")
_OTHER_SCRIPT = re.compile(r"[Ѐ-ӿ㐀-鿿぀-ヿ가-힣]")
_LATIN = re.compile(r"[A-Za-zÀ-ɏ]+")
_UMLAUT = re.compile(r"[äöüß]")
_TILDE = re.compile(r"[ñ¿¡]")


def _hits(text: str) -> tuple[int, dict[str, float]]:
    """(Latin letters, function words by language) of the distinct words: a word
    that is said over and over is one word."""
    words = set(_LATIN.findall(text))
    votes: dict[str, float] = {}
    for w in words & _KNOWN:
        for lang in _LANGUAGES[w]:
            votes[lang] = votes.get(lang, 0.0) + 1.0
    if len(votes) > 1 and not text.isascii():
        if "de" in votes:
            votes["de"] += 0.3 * len(_UMLAUT.findall(text))
        if "es" in votes:
            votes["es"] += 0.3 * len(_TILDE.findall(text))
    return sum(map(len, words)), votes


def _votes(sentence: str, prefer: str = "") -> tuple[int, str]:
    """(Latin letters, the language most of their function words vote for or '');
    of languages with equally many ``prefer``, then the first by name."""
    size, votes = _hits(sentence)
    if not votes:
        return size, ""
    most = max(votes.values())
    return size, prefer if votes.get(prefer) == most else min(lang for lang, n in votes.items() if n == most)


def _size(pattern: re.Pattern, text: str) -> int:
    return sum(map(len, pattern.findall(text)))


def _scripts(plain: str) -> dict[str, float]:
    """Letters of the scripts that tell their language."""
    if plain.isascii() or not _OTHER_SCRIPT.search(plain):
        return {}
    kana, han = _size(_KANA, plain), _size(_HAN, plain)
    sizes = {"ja" if kana > 0.2 * han else "zh": 3.0 * (han + kana), "ru": float(_size(_CYR, plain)), "ko": 2.0 * _size(_HANGUL, plain)}
    return {lang: n for lang, n in sizes.items() if n}


def language(text: str, prefer: str = "") -> dict[str, float]:
    """Letters by language, names in brackets aside. A Han character weighs as
    three letters of an alphabet. Each sentence's Latin letters go whole to the
    language its function words vote for, on a tie to ``prefer``; a sentence
    without any to the language most of the others have, or to ``latin``."""
    plain = NAME.sub(" ", text).lower()
    out = _scripts(plain)
    latin: dict[str, float] = {}
    mute = 0
    for sentence in SENTENCES.split(plain):
        if sentence:
            size, lang = _votes(sentence, prefer)
            if lang:
                latin[lang] = latin.get(lang, 0.0) + size
            else:
                mute += size
    if mute:
        most = max(sorted(latin), key=latin.__getitem__) if latin else "latin"
        latin[most] = latin.get(most, 0.0) + mute
    return out | latin


def main_language(text: str) -> tuple[str, float]:
    """(the language most of a text is in, its share of the letters), from the
    text as a whole; ("", 0.0) for a text without letters."""
    plain = NAME.sub(" ", text).lower()
    w = _scripts(plain)
    size, lang = _votes(plain)
    if size:
        w[lang or "latin"] = size
    total = sum(w.values())
    if not total:
        return "", 0.0
    top = max(sorted(w), key=w.__getitem__)
    return top, w[top] / total


def surely(text: str, lang: str) -> bool:
    """True only if ``language(text, lang)`` must give ``lang`` at least half of
    the letters, so that nothing need be counted sentence by sentence.

    For the language of a script: its letters are at least as many as all others
    together. For one in Latin letters: no other script occurs, and every
    function word of any language is one of its own, so that it has the most
    votes or a tie in every sentence.
    """
    plain = NAME.sub(" ", text).lower()
    if lang not in FUNCTION_WORDS:
        w = _scripts(plain)
        own = w.get(lang, 0.0)
        return own > 0 and own >= sum(w.values()) - own + _size(_LATIN, plain)
    known = _KNOWN.intersection(_LATIN.findall(plain))
    if not known or not all(lang in _LANGUAGES[w] for w in known):
        return False
    if plain.isascii():
        return True
    return not (_OTHER_SCRIPT.search(plain) or lang != "de" and _UMLAUT.search(plain) or lang != "es" and _TILDE.search(plain))
