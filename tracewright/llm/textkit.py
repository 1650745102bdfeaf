"""Plain-Python text helpers that the Arrow stages of this package share."""

from __future__ import annotations

import unicodedata

import regex

#: Frequent function words by language, used to name the language of a text.
FUNCTION_WORDS = {
    "en": "the and is are was were of to in that this with for on it as at by from not be have has had but or an which when you your my we our they their can could would should there what how why who after before again once only both other please",
    "de": "der die das und ist sind war nicht ein eine einen einem einer des dem den mit auf für von zu im in dass wenn weil aber auch als bei nach vor noch wie was warum wurde wird kann hier dort ich du er sie wir ihr mich dich sich aus über unter zwischen bitte diese dieser sehr durch oder",
    "es": "el la los las un una unos unas y es son fue no de del en que con por para se su sus al lo como más pero porque cuando donde desde hasta hay esta este esto está están ha han he qué cómo yo tú nos les muy sin sobre entre ya",
    "fr": "le la les un une des et est sont était ne pas de du en que qui avec pour par sur dans ce cette ces il elle nous vous je tu se sa son ses au aux plus mais car quand où depuis jusqu a ont été être fait comme y donc peut sans entre",
}
_WORD_LANGS: dict[str, list[str]] = {}
for _lang, _words in FUNCTION_WORDS.items():
    for _w in _words.split():
        _WORD_LANGS.setdefault(_w, []).append(_lang)

_PROSE = regex.compile(r"(?<![\w/.\-])\p{L}+(?:['’]\p{L}+)?(?![\w/\-]|\.\w)")
_CJK = regex.compile(r"[一-鿿]")
_SPAN = regex.compile(r"```.*?(?:```|\Z)|`[^`\n]*`", regex.S)
_INVISIBLE = regex.compile(r"[\p{Cf}\p{Cc}⠀ㅤᅟᅠﾠ͏]")
_VISIBLE = regex.compile(r"[^\s\p{Z}\p{C}⠀ㅤᅟᅠﾠ͏]")
WORD = regex.compile(r"\w+")


def visible(text: str | None) -> bool:
    """Whether the text holds a character that shows."""
    return bool(text) and _VISIBLE.search(text) is not None


def strip_invisible(text: str) -> str:
    return regex.sub(r"[\p{Cf}⠀ㅤᅟᅠﾠ͏]", "", text)


def plain_words(text: str | None) -> list[str]:
    """Words as runs of letters, digits or underscores; Unicode form, case and invisible characters set aside."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", strip_invisible(unicodedata.normalize("NFKC", text)))
    return WORD.findall(text.casefold())


def language(text: str | None, least: float = 2.0) -> str | None:
    """The natural language of a text: en, de, es, fr, zh or None where the evidence is thin.

    Code spans, paths and identifiers give no evidence.  A word that several languages share counts
    in parts.  The best language must lead the next by a fifth.
    """
    if not text:
        return None
    if "`" in text:
        text = _SPAN.sub(" ", text)
    if not text.isascii():
        han = len(_CJK.findall(text))
        if han >= 6:
            latin = sum(1 for w in _PROSE.findall(text) if w.lower() in _WORD_LANGS)
            if han > 2 * latin:
                return "zh"
    score = {"en": 0.0, "de": 0.0, "es": 0.0, "fr": 0.0}
    for w in _PROSE.findall(text):
        w = w.lower()
        for part in (w,) if "'" not in w and "’" not in w else regex.split(r"['’]", w):
            langs = _WORD_LANGS.get(part)
            if langs:
                share = 1.0 / len(langs)
                for one in langs:
                    score[one] += share
        if not w.isascii():
            if any(c in "äöüß" for c in w):
                score["de"] += 0.5
            if any(c in "ñ¿¡óíú" for c in w):
                score["es"] += 0.5
            if any(c in "èêàçùœî" for c in w):
                score["fr"] += 0.5
    ranked = sorted(score.items(), key=lambda x: -x[1])
    if ranked[0][1] >= least and ranked[0][1] > 1.2 * ranked[1][1]:
        return ranked[0][0]
    return None
