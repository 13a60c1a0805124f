"""Problem 8: personal information in free text, by a semi-Markov conditional random field.

Every segment of up to MOST_PARTS words that is capitalised throughout or holds a
listed name, and every segment of the shape of an address, a number or a mailbox,
is a candidate.  A candidate has a score for its kind, the sum of the weights of
features of the whole span: its shape, its grouping of digits, the names it is
built of and those its words resemble, the kinds of words around it.  Text
outside of mentions scores 0.  Among all ways to choose candidates that don't
overlap, dynamic programming over the ends of candidates finds the best, which
settles boundaries and kinds together.  No list of cues or stop words decides
what is a candidate; they are features, and the weights choose.  The weights
maximise the conditional likelihood of TRAINING_SENTENCES synthetic sentences
(module ``pii_training``) with the names of the list; they are trained at the
driver within seconds.

Defined results: null, empty and blank texts have no mentions and stay as they
are; null ids are dropped by ``mentions``; repeated rows give one result each in
``redact`` and one together in ``mentions``; whole texts are read, however long.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decidra.llm import pii_training as T
from decidra.llm.encoding import TOKENIZERS, read_ranks

KINDS = ("name", "email", "phone", "id_number", "address")
#: The bounded sample of labelled sentences, passes over it, and the penalty of large weights.
TRAINING_SENTENCES, PASSES, PENALTY, SEED = 14_000, 4, 2e-4, 11
#: Most words of a name: the bound of segments of the field.
MOST_PARTS = 7
#: Most names of the list; it goes to all tasks.
MOST_NAMES = 200_000
ROWS = 500
#: Public vocabularies whose whole lower-case words count as ordinary ones (a feature; a missing file gives none).
VOCABULARIES = (f"{TOKENIZERS}/byte_bpe_50k.tiktoken", f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken")


def folded(word: str) -> str:
    """Lower case without accents."""
    if word.isascii():
        return word.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", word.lower()) if not unicodedata.combining(c))


@dataclass(frozen=True)
class Candidate:
    start: int
    end: int
    kind: str
    features: tuple


_WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|[̀-ͯ])*(?:['’\-][^\W\d_](?:[^\W\d_]|[̀-ͯ])*)*\.?")
_AT = re.compile(r"[@＠]|&#64;|%40|\s?[\[({<]\s?at\s?[\])}>]\s?|\sat\s(?=[\w-]+(?:\sdot\s[\w-]+)+)", re.I)
_AT_WORD = re.compile(r"[aA][tT]\s?[\])}> \t\r\n]")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._+-")
_DOMAIN = re.compile(r"([^\W_][\w-]*)((?:\s?(?:[\[({]\s?(?:dot|\.)\s?[\])}])\s?|\sdot\s|[.。])[^\W_][\w-]*)+", re.I)
_NUMBER = re.compile(r"(?<![\w.'+/\-#$%])(?:\+\s?|\()?\d(?:[  ./\-()]{0,2}\d){6,24}(?![\w%])")
_CODE = re.compile(r"(?<![\w.'/\-#$@])(?:[A-Za-z]{2}[ \-]?\d{2}[ \-]?\d{2}[ \-]?\d{2}[ \-]?[A-Za-z]|[A-Za-z]{1,2}\d{6,9}|[A-Za-z]\d{2}[A-Za-z]\d{5}|\d{7,8}-?[A-Za-z])(?![\w\-]|\.\d)")
_CAP = r"[^\W\d_][\w'’\-]*"
_STREET_EN = re.compile(rf"(?<![\w.'#])(\d{{1,5}}[A-Za-z]?) ((?:{_CAP} ){{1,3}})(St|Street|Rd|Road|Ave|Avenue|Blvd|Boulevard|Lane|Ln|Court|Ct|Terrace|Drive|Dr|Way|Place|Square)\b\.?", re.I)
_STREET_FR = re.compile(rf"(?<![\w.'#])\d{{1,5}}(?: ?(?:bis|ter|quater))?,? (?:rue|avenue|av\.|bd|boulevard|impasse|place|chemin|quai|allée|route|cours) (?:{_CAP}[ ,]){{1,5}}", re.I)
_STREET_DE = re.compile(rf"(?<!\w)((?:{_CAP} ){{0,2}}{_CAP}(?:\.|(?<=\w))) (\d{{1,4}}(?: ?[a-z](?!\w))?), (\d{{4,5}}) ({_CAP}(?: (?:am|an der|im|ob der) {_CAP})?)")
_STREET_ES = re.compile(rf"(?<!\w)(?:Calle|C/|Avda\.?|Avenida|Plaza|Pza\.?|Paseo|Camino|Ronda) ?(?:{_CAP} ){{1,5}}\d{{1,4}}", re.I)
_TOWN = re.compile(rf"(?:, (?:Apt|Unit|Suite) \w+| ?#\w+|, \w{{1,4}}[º°]\w?|, piso \w+|, bajo)?(?:(?:, | - |\r?\n|,\r?\n)(?:(?:[A-Z]{{2}} )?\d{{4,5}} {_CAP}(?: {_CAP}){{0,3}}|{_CAP}(?: {_CAP})?(?:,? (?:[A-Z]{{2}} )?\d{{4,5}})?))?")
#: The words that the patterns of streets hold, by language.
_STREET_WORDS = {"en": "st street rd road ave avenue blvd boulevard lane ln court ct terrace drive dr way place square", "fr": "rue av bd impasse chemin quai allee route cours", "es": "calle c avda avenida plaza pza paseo camino ronda"}
_STREET_WORD_OF = {w: k for k, ws in _STREET_WORDS.items() for w in ws.split()}
_STREET_WORD_OF |= {w: "en fr" for w in ("avenue", "boulevard", "place")}
_DIGIT = re.compile(r"\d")
_GERMAN_NUMBER = re.compile(r"\d{1,4}(?: ?[a-z])?, \d{4,5} ")
_GERMAN_STREET = re.compile(r"(?:straße|strasse|str\.|weg|gasse|allee|platz|ring|damm|ufer|graben|steig|hof)$", re.I)
_BEFORE = re.compile(r"([^\W_]+|[^\w\s])[\s\"']*$")
_AFTER = re.compile(r"(?:'s)?[\s\"']*([^\W_]+|[^\w\s])")


#: Kinds of words next to a mention, in four languages: function words and what people are called or do, no words of any corpus.
_CUES = {
    "by": "by von par por per from de durch bei chez avec mit con with to an für for pour para via than als que",
    "contact": "call ask contact ping email mail tell notify meet met see thank thanks thx cc bcc attn dear hi hello hey hola bonjour lieber liebe rufen fragen bitte appelez contactez llame llamad pregunte regards wishes cheers cordialement saludos sincerely grüßen",
    "title": "dr prof mr mrs ms herr frau herrn m mme mlle sr sra ing don doña sir señor señora",
    "role": "author owner reviewer engineer colleague maintainer contact manager tester user name student neighbour customer speaker chair assignee assigned approved kollege kollegin kunde autor auteur contacto speaker",
    "source": "according laut selon según nach after",
    "and": "and und et y e or oder ou o",
    "negated": "not but only neither nor even nur nicht sauf solo",
    "verb": "says said thinks told replied wrote writes asked reported confirmed agrees repaired fixed approved signed found noted suggested added knows did does has had have will would can could is was are were be been may should must hat haben war ist sind wird kann soll sagte schrieb meint a ont est était sera dit écrit pense ha han fue es está dice dijo será viene gave took saw went came knows explained",
    "determiner": "the a an this that these those each every any all some no its our their der die das ein eine kein le la les un une el los las una al del",
    "function": "ohne zwischen gegen über unter auf aus um in on at into onto over under between against without within during through about like near off out up down ohne sans sous sur dans entre contre depuis vers sin sobre entre contra hasta desde en bajo why how what who which where whose there here then now also too very just still again always never often once soon yes no nein oui non sí je tu il elle nous vous ils elles ich du er sie es wir ihr yo tú él ella nosotros i you he she it we they me him her us them so such same other another both all many much few more most less least than because since until although though unless whether however therefore must please due own y ni si como pero porque aunque mais donc car ni comme parce aber denn sondern weil dass ob obwohl jedoch also",
    "when": "yesterday today tomorrow monday tuesday wednesday thursday friday when if while as gestern heute morgen wenn hier demain quand si ayer hoy mañana cuando",
}
#: Kinds of words that say what a number is, in four languages.
_NUMBER_CUES = {
    "id": "passport passports identity id ids ssn social security insurance badge licence card tax payroll visa ausweis personalausweis reisepass pass ausweisnummer steuer versicherung passeport identité sécu sécurité carte pasaporte dni nie nif cédula identidad seguridad documento documentos residence permit national",
    "phone": "phone phones telephone tel telefon telefonnummer anruf anrufen anschluss mobil mobile handy cell fax call calls dial ring hotline office extension reach joignable téléphone portable appelez fixe teléfono móvil llama llamad llámame whatsapp sms text",
    "count": "hash hashes commit commits checksum seed build revision rev version firmware timestamp time serial order ticket lot part page line lines table section range lane packet packets bytes cycles value values sum count merge merging revert cherry pick checkout clone release prüfsumme startwert zeile ligne línea valor valeur wert code fusionner integrar zusammenführen",
}
_NUMBER_CUE_OF = {folded(w): k for k, ws in _NUMBER_CUES.items() for w in ws.split()}
_LETTERS = re.compile(r"[^\W\d_]+")
_CUE_OF = {w: k for k, ws in _CUES.items() for w in ws.split()}
_NOUN_END = re.compile(r"(?:tion|sion|ment|ness|ity|ing|ance|ence|ture|ware|age|ung|heit|keit|schaft|nis|eur|dad|ción|er|or|al|ic|ed|ly|us|um)s?$")


@lru_cache(maxsize=4)
def ordinary_words(paths: tuple[str, ...] = VOCABULARIES) -> frozenset[str]:
    """Words of three letters or more, in lower case, that are one token after a blank in a public vocabulary."""
    out = set()
    for path in paths:
        if Path(path).exists():
            for token in read_ranks(path):
                word = token.decode("utf-8", "replace")
                if word[:1] == " " and len(word) > 3 and word[1:].isalpha() and word.islower():
                    out.add(folded(word[1:]))
    return frozenset(out)


class Lexicon:
    """The listed names and ordinary words, and what they say about a word."""

    def __init__(self, given: Sequence[str], family: Sequence[str], ordinary: Sequence[str] | None = None):
        self.ordinary = ordinary_words() if ordinary is None else frozenset(ordinary)
        self.given = frozenset(folded(x) for x in given)
        self.family = frozenset(folded(x) for x in family)
        self.starts = Counter(x[:4] for x in self.family if len(x) > 5) + Counter(x[:3] for x in self.given if len(x) > 4)
        self.ends = Counter(x[-4:] for x in self.family if len(x) > 5) + Counter(x[-3:] for x in self.given if len(x) > 4)
        self.of_word = lru_cache(maxsize=200_000)(self._of_word)

    def part(self, word: str) -> str:
        """g, f, i (initial), or '' for an unlisted word; a hyphenated word is a family name if a part of it is."""
        w = word[:-1] if word.endswith(".") else word
        if len(w) == 1:
            return "i" if word.endswith(".") or w.isupper() else ""
        w = folded(w)
        if w.endswith(("'s", "’s")):
            w = w[:-2]
        if w in self.family:
            return "f"
        if w in self.given:
            return "g"
        if "-" in w:
            parts = w.split("-")
            if any(p in self.family for p in parts):
                return "f"
            if all(p in self.given for p in parts):
                return "g"
        return ""

    def _of_word(self, word: str) -> tuple[str, str, str, str, str]:
        """(part, shape, cue, likeness, street): U, T or l for an unlisted part; the kind of cue it is; how it resembles listed names; the language of the street word it is."""
        part, shape, low = self.part(word), _shape(word), folded(word.rstrip("."))
        like = ""
        if part == "":
            part = shape if len(low) > 1 else "l"
            like = ("s" if self.starts[low[:4]] or self.starts[low[:3]] else "") + ("e" if self.ends[low[-4:]] > 1 or self.ends[low[-3:]] > 1 else "")
            like += "o" if low in self.ordinary or low in _CUE_OF else "n" if _NOUN_END.search(low) else ""
        return part, shape, _CUE_OF.get(low, ""), like, _STREET_WORD_OF.get(low, "")


def _shape(word: str) -> str:
    w = word.rstrip(".")
    return "U" if len(w) > 1 and w.isupper() else "T" if w[:1].isupper() else "l"


def _kind_of(token: str) -> str:
    """A neighbour by its cue, else by what it is made of."""
    cue = _CUE_OF.get(token.lower())
    if cue:
        return cue
    if not token[:1].isalnum():
        return token
    return "number" if token[0].isdigit() else "U" if len(token) > 1 and token.isupper() else "T" if token[0].isupper() else "l"


def _around(text: str, start: int, end: int) -> tuple[str, str, str, bool]:
    """The word or sign before, the one before that, the one after, and whether a neighbour is in capitals."""
    left = text[max(0, start - 40) : start]
    m = _BEFORE.search(left)
    before = m[1] if m else "^"
    m2 = _BEFORE.search(left[: m.start()]) if m else None
    a = _AFTER.match(text, end, end + 30)
    after = a[1] if a else "$"
    return before, m2[1] if m2 else "^", after, any(len(w) > 1 and w.isalpha() and w.isupper() for w in (before, after))


_GAPS = {" ": "", "\t": "", "\xa0": "", ", ": ",", ",": ",", "\n": "n", "\r\n": "n", "\n ": "n"}


def _names(text: str, words: list[re.Match], info: list[tuple], out: list[Candidate]) -> None:
    n = len(words)
    begins = [i for i, x in enumerate(info) if x[0] != "l"]
    begins += [i - 1 for i in begins if i and info[i][0] in "gf" and info[i - 1][0] == "l"]
    for i in begins:
        part = info[i][0]
        if part == "i" and not (i + 1 < n and (info[i + 1][0] != "l")):
            continue
        s = words[i].start()
        if s and (text[s - 1] in "@＠_" or text[s - 1].isdigit()):
            continue
        left = None
        gaps, kinds, listed, lower = "", part, part in "gf", part == "l"
        for j in range(i + 1, min(n, i + MOST_PARTS)):
            before_end, start = words[j - 1].end(), words[j].start()
            gap = text[before_end:start]
            g = _GAPS.get(gap)
            if g is None:
                if gap == "" and words[j - 1][0].endswith("."):
                    g = ""
                elif len(gap) <= 3 and gap and not gap.strip(" \t\xa0\u2009\u202f"):
                    g = "w"
                else:
                    break
            if words[j - 1][0].endswith(".") and (info[j - 1][0] != "i" or g == "n"):
                break
            p = info[j][0]
            kinds += p
            gaps += g or "s"
            listed += p in "gf"
            lower += p == "l"
            if lower and (j > i + 1 or not listed):  # a word in lower case only beside a listed name
                break
            if kinds.strip("i") == "":
                continue
            e = words[j].end()
            word = words[j][0]
            if word.endswith(".") and p != "i":
                e -= 1
            tail = word.endswith(("'s", "’s"))
            if tail:
                e -= 2
            follows = text[e : e + 1]
            if follows in ("@", "＠", "_") and follows or follows.isdigit():
                break
            if left is None:
                before, before2, _, loud_left = _around(text, s, s)
                left = (before.lower(), _kind_of(before), _kind_of(before2))
                opens = s == 0 or text[s - 1] == "\n" or before in ".!?:"
            a = _AFTER.match(text, e, e + 30)
            after = a[1] if a else "$"
            loud = loud_left or len(after) > 1 and after.isalpha() and after.isupper()
            span = info[i : j + 1]
            shapes = "".join(sorted({x[1] for x in span if x[0] != "i"}))
            unlisted = [x for x in span if x[0] in "TUl"]
            some = min(int(listed), 2)
            left_kind, right_kind = left[1], _kind_of(after)
            out.append(
                Candidate(
                    s,
                    e,
                    "name",
                    (
                        "bias",
                        ("pattern", re.sub("[TU]", "x", kinds)),
                        ("initials", "".join("u" if x[1] == "T" else "l" for x in span if x[0] == "i"), "l" if shapes == "l" else "u", some),
                        ("shapes", shapes, some),
                        ("gaps", gaps),
                        ("gaps", gaps.strip("s"), some),
                        ("listed", int(listed), len(kinds)),
                        ("left", left_kind, some),
                        ("left2", left[2], some),
                        ("right", right_kind, some),
                        ("both", left_kind, right_kind, some),
                        ("before", left[0]),
                        ("after", after.lower()),
                        ("first cue", span[0][2] if span[0][0] in "TUl" else ""),
                        ("cues", sum(bool(x[2]) for x in unlisted), some),
                        ("likes", "".join(sorted(x[3].replace("n", "").replace("o", "") or "-" for x in unlisted)), some),
                        ("noun ends", sum("n" in x[3] for x in unlisted), some),
                        ("ordinary", sum("o" in x[3] for x in unlisted), len(unlisted), some),
                        ("first", span[0][3][-1:], some),
                        ("last", span[-1][3][-1:], some),
                        ("loud", loud, "U" in shapes, some),
                        ("lower", int(lower), some),
                        ("possessive", tail),
                        ("opens", opens, kinds),
                        ("opens", opens, span[0][0], span[0][3], some),
                        ("first letter", words[i][0][-1:] if span[0][0] in "TUl" else "", opens),
                        ("first end", words[i][0][-2:] if span[0][0] in "TUl" else "", opens),
                        ("line", follows in ("\n", "\r", ""), left_kind, some),
                    ),
                )
            )
            if tail:
                break


def _emails(text: str, out: list[Candidate]) -> None:
    if not ("@" in text or "＠" in text or "&#64;" in text or "%40" in text or _AT_WORD.search(text)):
        return
    for m in _AT.finditer(text):
        s = m.start()
        while s > 0 and text[s - 1] in _LOCAL_CHARS:
            s -= 1
        while s < m.start() and text[s] in "._+-":
            s += 1
        if s == m.start():
            continue
        d = _DOMAIN.match(text, m.end())
        if d is None:
            continue
        sign = m[0].strip()
        last = re.split(r"[^\w-]+", d[0])[-1]
        written = "plain" if sign in "@＠" else "word" if sign.lower() == "at" else "bracket"
        out.append(Candidate(s, d.end(), "email", ("bias", ("sign", written), ("top", last.isalpha()), ("host digit", d[1][0].isdigit()), ("underscore", "_" in d[0]), ("length", min(len(last), 8)))))


def _groups(s: str) -> str:
    return "-".join(str(len(g)) for g in re.findall(r"\d+", s))


def _near(text: str, start: int, end: int) -> str:
    """The kind of the nearest telling word among the five before a number on its line, else among the two after it."""
    left = _LETTERS.findall(text[max(0, start - 60) : start].rsplit("\n", 1)[-1])[-5:]
    for w in [*reversed(left), *_LETTERS.findall(text[end : end + 24].split("\n", 1)[0])[:2]]:
        if cue := _NUMBER_CUE_OF.get(folded(w)):
            return cue
    return ""


def _numbers(text: str, out: list[Candidate]) -> None:
    for m in _NUMBER.finditer(text):
        s = m[0]
        digits = sum(c.isdigit() for c in s)
        before, before2, after, loud = _around(text, m.start(), m.end())
        signs = "".join(sorted({c for c in s if not c.isdigit()}))
        lead = "+" if s[0] == "+" else "(" if s[0] == "(" else "00" if s[:2] == "00" else "0" if s[0] == "0" else "n"
        groups = _groups(s)
        n = min(digits, 20)
        near = _near(text, m.start(), m.end())
        features = ("bias", ("groups", groups), ("lead", lead), ("groups", groups, lead), ("signs", signs), ("digits", n), ("digits", n, lead), ("digits", n, signs), ("before", before.lower()), ("before", before.lower(), before2.lower()), ("before2", before2.lower()), ("left", _kind_of(before)), ("left", _kind_of(before), n), ("right", _kind_of(after)), ("after", after.lower()), ("parts", groups.count("-") + 1), ("near", near), ("near", near, n, signs), ("near", near, lead))
        out.append(Candidate(m.start(), m.end(), "phone", features))
        out.append(Candidate(m.start(), m.end(), "id_number", features))
    for m in _CODE.finditer(text):
        before, before2, after, loud = _around(text, m.start(), m.end())
        shape = re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", m[0])))
        near = _near(text, m.start(), m.end())
        out.append(Candidate(m.start(), m.end(), "id_number", ("bias", "code", ("near", near, "code"), ("near", near, shape), ("shape", shape), ("form", shape.strip("Aa9"), len(shape)), ("case", "a" in shape), ("letters", shape.count("A") + shape.count("a"), len(shape)), ("before", before.lower()), ("before", before.lower(), before2.lower()), ("left", _kind_of(before), "code"), ("right", _kind_of(after), "code"), ("after", after.lower()))))


def _addresses(text: str, streets: str, out: list[Candidate]) -> None:
    """streets names the languages whose street words the text has; German forms need a house number, a comma and a code."""

    def add(start: int, end: int, form: str, *more) -> None:
        tail = _TOWN.match(text, end)
        town = tail[0] if tail else ""
        before, _, _, _ = _around(text, start, end)
        shared = ("bias", ("form", form), ("left", _kind_of(before)), ("left", _kind_of(before), form), *more)
        out.append(Candidate(start, end + len(town), "address", (*shared, ("town", bool(town)), ("code", bool(re.search(r"[0-9]{4,5}", town))))))
        if town:
            out.append(Candidate(start, end, "address", (*shared, "cut")))

    for m in _STREET_EN.finditer(text) if "en" in streets else ():
        add(m.start(), m.end(), "en", ("case", m[2][0].isupper()), ("words", m[2].count(" ")), ("type", m[3].lower()))
    for m in _STREET_FR.finditer(text) if "fr" in streets else ():
        add(m.start(), len(text[: m.end()].rstrip(" ,")) if m[0][-1] in " ," else m.end(), "fr")
    for m in _STREET_ES.finditer(text) if "es" in streets else ():
        add(m.start(), m.end(), "es")
    for m in _STREET_DE.finditer(text) if _GERMAN_NUMBER.search(text) else ():
        words = m[1].split(" ")
        for k in range(len(words)):
            start = m.start() + sum(len(w) + 1 for w in words[:k])
            tail = bool(_GERMAN_STREET.search(words[-1]))
            lead = words[k].lower() in ("am", "an", "im", "alte", "unter", "auf", "zum", "zur", "neue", "obere", "untere")
            if len(words) - k > 1 and not (lead or tail) or not words[k][0].isupper():
                continue
            before, _, _, _ = _around(text, start, m.end())
            out.append(Candidate(start, m.end(), "address", ("bias", ("form", "de"), ("street", tail), ("lead", lead), ("words", len(words) - k), ("words", len(words) - k, lead, tail), ("left", _kind_of(before)), ("left", _kind_of(before), "de"))))


def candidates(text: str, lex: Lexicon) -> list[Candidate]:
    """All candidates of a text in the order of their ends."""
    out: list[Candidate] = []
    words = list(_WORD.finditer(text))
    of_word = lex.of_word
    info = [of_word(m[0]) for m in words]
    streets = " ".join({x[4] for x in info})
    _emails(text, out)
    if _DIGIT.search(text):
        _numbers(text, out)
        _addresses(text, streets, out)
    _names(text, words, info, out)
    out.sort(key=lambda c: (c.end, c.start, c.kind))
    return out


@dataclass(frozen=True)
class Model:
    """Names, ordinary words, and by kind the weight of each feature."""

    given: tuple[str, ...]
    family: tuple[str, ...]
    ordinary: tuple[str, ...]
    weights: dict[str, dict]

    def score(self, c: Candidate) -> float:
        get = self.weights[c.kind].get
        return sum([get(f, 0.0) for f in c.features])


def _previous(found: list[Candidate]) -> list[int]:
    """For each candidate how many end at or before its start."""
    ends = [c.end for c in found]
    return [bisect_right(ends, c.start) for c in found]


def best_segments(found: list[Candidate], scores: list[float]) -> list[Candidate]:
    """The non-overlapping candidates of the highest total score, by dynamic programming over their ends."""
    before = _previous(found)
    best = [0.0] * (len(found) + 1)
    taken = [False] * len(found)
    for i, s in enumerate(scores):
        with_it = best[before[i]] + s
        taken[i] = with_it > best[i]
        best[i + 1] = max(best[i], with_it)
    out, i = [], len(found)
    while i:
        if taken[i - 1]:
            out.append(found[i - 1])
            i = before[i - 1]
        else:
            i -= 1
    return out[::-1]


def _marginals(found: list[Candidate], scores: list[float]) -> list[float]:
    """The probability of each candidate under the field, by the forward and backward sums over segmentations."""
    n = len(found)
    before = _previous(found)
    forward = [0.0] * (n + 1)  # logarithms
    for i in range(n):
        a, b = forward[i], forward[before[i]] + scores[i]
        forward[i + 1] = max(a, b) + math.log1p(math.exp(-abs(a - b)))
    backward = [-math.inf] * (n + 1)
    backward[n] = 0.0
    for i in range(n - 1, -1, -1):
        for j, v in ((i, backward[i + 1]), (before[i], backward[i + 1] + scores[i])):
            x = backward[j]
            backward[j] = v if x == -math.inf else max(x, v) + math.log1p(math.exp(-abs(x - v)))
    return [math.exp(min(0.0, forward[before[i]] + scores[i] + backward[i + 1] - forward[n])) for i in range(n)]


def train(given: list[str], family: list[str], sentences: int = TRAINING_SENTENCES, passes: int = PASSES, seed: int = SEED, frames: Sequence[str] = T.FRAMES) -> Model:
    """Weights of the highest penalised conditional likelihood, by adaptive gradient steps; the same for the same names."""
    given, family = sorted(set(given)), sorted(set(family))
    lex = Lexicon(given, family)
    examples = []
    for s in T.sentences(given, family, sentences, seed, frames):
        found = candidates(s.text, lex)
        # of a mention whose end is open the longest candidate with its start is the right one
        right: dict[tuple[str, int], int] = {}
        for i, c in enumerate(found):
            for a, b, kind in s.spans:
                if c.kind == kind and c.start == a and (c.end == b or kind == "address" and c.end > a):
                    if (kind, a) not in right or abs(c.end - b) < abs(found[right[kind, a]].end - b):
                        right[kind, a] = i
        if found:
            examples.append((found, set(right.values())))
    weights: dict[str, dict] = {k: {} for k in KINDS}
    squares: dict[str, dict] = {k: {} for k in KINDS}
    for _ in range(passes):
        for found, chosen in examples:
            scores = [sum([weights[c.kind].get(f, 0.0) for f in c.features]) for c in found]
            for i, p in enumerate(_marginals(found, scores)):
                g = (i in chosen) - p
                if abs(g) < 1e-4:
                    continue
                w, q = weights[found[i].kind], squares[found[i].kind]
                for f in found[i].features:
                    old = w.get(f, 0.0)
                    step = g - PENALTY * old
                    q[f] = q.get(f, 1e-2) + step * step
                    w[f] = old + 0.4 * step / math.sqrt(q[f])
    return Model(tuple(given), tuple(family), tuple(sorted(lex.ordinary)), weights)


def find(text: str | None, model: Model, lex: Lexicon) -> list[Candidate]:
    """The mentions of a text in order."""
    if not text or text.isspace():
        return []
    found = candidates(text, lex)
    return best_segments(found, [model.score(c) for c in found]) if found else []


PLACEHOLDERS = {"name": "[NAME]", "email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]"}


def replaced(text: str | None, found: list[Candidate]) -> str | None:
    """The text with a placeholder for each mention, the rest unchanged."""
    if not found or text is None:
        return text
    out, at = [], 0
    for c in found:
        out += [text[at : c.start], PLACEHOLDERS[c.kind]]
        at = c.end
    return "".join([*out, text[at:]])


_lexica: dict[int, Lexicon] = {}


def _lexicon(model: Model) -> Lexicon:
    key = hash((model.given, model.family, model.ordinary))
    if key not in _lexica:
        _lexica[key] = Lexicon(model.given, model.family, model.ordinary)
    return _lexica[key]


def _mention_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = _lexicon(model)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                rows = [(i, c.kind, c.start, c.end) for i, t in zip(*(c.to_pylist() for c in whole.slice(at, ROWS).columns)) for c in find(t, model, lex)]
                columns = list(zip(*rows)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=["doc_id", "kind", "start_pos", "end_pos"])

    return run


def _redact_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = _lexicon(model)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = [find(t, model, lex) for t in batch.column(1).to_pylist()]
                texts = [replaced(t, f) for t, f in zip(batch.column(1).to_pylist(), found)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([len(f) for f in found], pa.int32())], names=["doc_id", "text", "n_mentions"])

    return run


def model_of(names: DataFrame) -> Model:
    """The model trained with the list (kind, name) of given and family names."""
    rows = names.filter("name is not null and kind is not null").select("kind", "name").distinct().limit(MOST_NAMES + 1).collect()
    if len(rows) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} names")
    by_kind = {k: sorted(r["name"] for r in rows if r["kind"] == k) for k in ("given", "family")}
    return train(by_kind["given"], by_kind["family"])


def mentions(documents: DataFrame, names: DataFrame) -> DataFrame:
    """(doc_id, kind, start_pos, end_pos), distinct; positions count code points from 0."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    return docs.mapInArrow(_mention_batches(model_of(names)), "doc_id long, kind string, start_pos long, end_pos long").distinct()


def redact(documents: DataFrame, names: DataFrame) -> DataFrame:
    """(doc_id, text, n_mentions) of every row, mentions replaced."""
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(_redact_batches(model_of(names)), "doc_id long, text string, n_mentions int")
