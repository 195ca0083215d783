"""A rule score of how sound an answer text is, from 0 (none) to 1."""

from __future__ import annotations

import re

from .answers import STOPWORDS, defect
from .repetition import share
from .residue import kind
from .text import CJK, fields_in_order, is_cjk

_ODD = re.compile("[#¤§^~|\\ufffd\\\\]")
_BROKEN = re.compile(r"[A-Za-zà-ÿ][0-9#¤§^~|�]+[A-Za-zà-ÿ]|(?<!\w)[b-hj-zB-HJ-Z](?= )")
_LETTER = re.compile(r"[^\W\d_]")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_WORD = re.compile(r"[^\W\d_][^\W_'’]*")
_ITEM = re.compile(r"\s*(?:[,;/|•·、，；]|\n\s*[-*+•]?|=\s*\d+\s*)\s*")
_PUNCTUATED = re.compile(r"[.,;:!?\"'«»„“”。、，！？「」()–—\n]")
_FUNCTION = frozenset(w for ws in STOPWORDS.values() for w in ws)
_VERB_MARKS = re.compile("[をがはにのでと了的在着从把被与]")
# The idiom of passing remarks in forums.
_CHAT = re.compile(
    r"\b(?:lol|lmao|omg|wtf|idk|tbh|srsly|thx|pls|plz|gr8|m8|u guys|r gr8|bump|necro|first!!|nvm|\+1|pm me|same here|haha|edit:|link dead|is op|nerf|who cares|mod pls|yeah ok|soooo+|anyone know)(?!\w)",
    re.I,
)
# How a question asks for a short answer.
_TERSE = re.compile(
    r"\b(?:in (?:one|a single) (?:line|word|sentence)|one[- ]line|in a word|briefly|en une (?:ligne|phrase)|en un mot|brièvement|in einer zeile|in einem (?:wort|satz)|kurz:|en una (?:línea|frase)|en una palabra|brevemente)\b"
    r"|一行で|一言で|一文で|手短に|[用以]?一(?:行|句话|个词)(?:话)?[说回:：答]?|简短",
    re.I,
)
#: From this score on an output is sound.
SOUND = 0.5


def score(question: str | None, answer: str | None) -> float:
    """1 less the weights of the flaws found: no answer, noise, remarks, lists of bare names, words without grammar, shouting,
    repetition, or next to nothing said; among equally flawless texts, longer and more varied ones score a little higher."""
    found = defect(question, answer)
    if found and found != "open" or not isinstance(answer, str):
        return 0.0
    if kind(answer):
        return 0.0
    text = answer.strip()
    letters = len(_LETTER.findall(text))
    terse = isinstance(question, str) and len(text) <= 200 and _TERSE.search(question) is not None
    if letters < 20 and not (terse and letters > 1):
        return 0.05
    cjk = is_cjk(text)
    words = _WORD.findall(text)
    flaw = 0.0
    odd = len(_ODD.findall(text)) + len(_BROKEN.findall(text))
    if odd * 60 > len(text):
        flaw += 0.8
    remarks = len(_CHAT.findall(text))
    if remarks and remarks * 12 >= len(words):
        flaw += 0.8
    if not cjk and len(_UPPER.findall(text)) > 0.6 * letters:
        flaw += 0.6
    if text.count("!") + text.count("！") >= 4 and text.count("!") * 60 > len(text):
        flaw += 0.6
    structured = fields_in_order(text) is not text
    again = share(text)
    if again > 0.3:
        flaw += min(1.0, again)
    if not structured:
        items = [x for x in _ITEM.split(text) if x.strip(" .")]
        bare = sum(len(x.split()) <= 2 and len(x) <= 24 for x in items)
        if len(items) >= 6 and bare >= 0.8 * len(items) or text.count("=") * 40 > len(text):
            flaw += 0.8
        if cjk:
            if letters > 40 and len(_PUNCTUATED.findall(text[:-1])) * 60 < letters and " " not in text.strip():
                flaw += 0.8
            size = letters / 2.2
        else:
            function = sum(w.lower() in _FUNCTION for w in words)
            if len(words) >= 8 and not terse and function < 0.2 * len(words):
                flaw += 0.8
            size = len(words)
        if size < 22 and not terse:
            flaw += 0.6
    fresh = len(set(words)) / max(1, len(words)) if not cjk else len(set(CJK.findall(text))) / max(1, letters)
    return max(0.0, 1.0 - flaw) * (0.9 + 0.05 * min(1.0, len(text) / 1500) + 0.05 * fresh)
