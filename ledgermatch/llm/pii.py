"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs,
digits, schemes, and cue words of accounts and addresses.  At each anchor a
parser of its own expands to the left and right, validates, and gives a span.
The base kinds follow fixed patterns; as anchors come in order and each kind
goes on behind its last match, the spans are just the leftmost non-overlapping
matches, in time linear in the text.

Further kinds: ``url`` (a scheme whose address carries a user or a personal
parameter), ``address`` (a street cue with a house number: ``12 Baker Street``,
``rue de la Paix 12``, ``12 rue de la Paix``, ``Lange Straße 12``,
``Hauptstraße 12``) and ``account`` (an
identifier cue with at least six digits behind it; an IBAN must have right
check digits).

Null texts count as empty.  Repeated rows give the same spans.  ``masked``
passes further columns through untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .spans import by_start, scanned

KINDS = ["email", "ip", "card", "phone", "url", "address", "account"]
BASE_KINDS = KINDS[:4]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_SCHEME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_URL_REST = re.compile(r"""[^\s<>"']+""")
_PERSONAL = re.compile(r"[?&](?:e?mail|user(?:name)?|name|phone|tel|account)=[^&#]+", re.IGNORECASE)
_STREET_LEFT = re.compile(r"[0-9]{1,5}[A-Za-z]?(?: [A-Z][\w'.-]*){1,4} ?$")
_STREET_RIGHT = re.compile(r"(?: [\w'.-]+){1,5},? (?:n[oº°]\.? ?)?[0-9]{1,5}\b")
_STREET_COMPOUND = re.compile(r"(?:[\w-]+|(?:(?<![\w-])[A-ZÀ-Þ][\w'-]* ){1,3})?$")
_NUMBER_RIGHT = re.compile(r",? (?:[Nn]r\.? ?)?[0-9]{1,5}[A-Za-z]?(?:-[0-9]{1,5}[A-Za-z]?)?\b")
_NUMBER_LEFT = re.compile(r"(?<!\w)[0-9]{1,5}(?:-[0-9]{1,5})?(?: ?(?:bis|ter|quater|[A-Za-z]))?,? $")
_STREET_NAME = re.compile(r"(?:(?: (?:de|du|des|la|le|les|et|en|sur|sous|au|aux)){0,3} (?:[dlDL]['’])?"
                          r"(?:l['’])?[A-ZÀ-Þ][\w'’-]*){1,4}|(?: du)? [0-9]{1,2}(?:er)? \w+(?: [0-9]{4}\b)?")
_ACCOUNT = re.compile(r"(?: ?(?:no|nr|num|number|id)\b\.?)?[ \t]*[:#=]?[ \t]*([A-Z]{0,4}[0-9](?:[ -]?[A-Z0-9]){5,33})\b")

#: Cue words and the parser that each one calls.
CUES = {
    "account": ["account", "acct", "iban", "konto", "compte", "cuenta", "passport", "ssn"],
    "left": ["street", "road", "lane"],
    "either": ["avenue", "boulevard"],
    "right": ["rue", "calle", "avenida"],
    "compound": ["straße", "strasse"],
}


def automaton():
    """The anchors, with the parser that each one calls."""
    a = ahocorasick.Automaton()
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("scheme", 3))
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
    for parser, cues in CUES.items():
        for cue in cues:
            for form in {cue, cue.capitalize(), cue.upper()}:
                a.add_word(form, (parser, len(form)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-1::-1]]
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(doubled)) % 10 == 0


def iban_ok(text: str) -> bool:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _word_char(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")


def find_spans(text: str, anchors) -> list[tuple[str, int, int]]:
    out: list[tuple[str, int, int]] = []
    done = dict.fromkeys(KINDS, 0)  # where each kind goes on

    def add(kind: str, start: int, end: int) -> None:
        out.append((kind, start, end))
        done[kind] = end

    for last, (parser, size) in anchors.iter(text):
        at = last - size + 1
        if parser == "digit":
            if at >= done["ip"]:
                if m := _IP.match(text, at):
                    done["ip"] = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.groups()):
                        add("ip", at, m.end())
                else:
                    done["ip"] = _DIGITS.match(text, at).end()
            if at >= done["card"]:
                if m := _CARD.match(text, at):
                    done["card"] = m.end()
                    digits = re.sub("[^0-9]", "", m[0])
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        add("card", at, m.end())
        elif parser == "at":
            start = at
            while start > done["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                add("email", start, m.end())
        elif parser == "plus":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                done["phone"] = m.end()
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    add("phone", at, m.end())
        elif parser == "scheme":
            start = at
            while start > done["url"] and text[start - 1] in _SCHEME_CHARS:
                start -= 1
            if start < at and at >= done["url"] and (m := _URL_REST.match(text, last + 1)):
                host = re.split(r"[/?#]", m[0], maxsplit=1)[0]
                if "@" in host or _PERSONAL.search(m[0]):
                    add("url", start, m.end())
                done["url"] = m.end()
        elif parser == "compound":
            if at >= done["address"] and not _word_char(text, last + 1):
                m = _NUMBER_RIGHT.match(text, last + 1)
                if m or not _word_char(text, at - 1) and (m := _STREET_RIGHT.match(text, last + 1)):
                    low = max(done["address"], at - 80)
                    add("address", _STREET_COMPOUND.search(text, low, at).start(), m.end())
        elif not (_word_char(text, at - 1) or _word_char(text, last + 1)):
            low = max(done["address"], at - 80)
            if parser in ("left", "either") and (m := _STREET_LEFT.search(text, low, at)):
                add("address", m.start(), last + 1)
            elif parser in ("either", "right"):
                if at >= done["address"]:
                    number = _NUMBER_LEFT.search(text, max(low, at - 20), at)
                    name = number and _STREET_NAME.match(text, last + 1)
                    right = parser == "right" and _STREET_RIGHT.match(text, last + 1)
                    if ends := [m.end() for m in (name, right) if m]:
                        add("address", number.start() if number else at, max(ends))
            elif parser == "account" and at >= done["account"] and (m := _ACCOUNT.match(text, last + 1)):
                plain = re.sub("[ -]", "", m[1])
                iban = re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", plain)
                if iban_ok(plain) if iban else sum(c in "0123456789" for c in plain) >= 6:
                    add("account", m.start(1), m.end(1))
    return by_start(out, KINDS)


def finder():
    anchors = automaton()
    return lambda text: find_spans(text, anchors)


def personal(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` (kind, start, end in code points) per document."""
    return scanned(docs, finder)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one, named by the first."""
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked; ``n_chars``, if there, follows the new text. Null texts stay null."""
    names = docs.columns
    text_at, n_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = finder()
        for b in batches:
            new = [None if (t := x.as_py()) is None else mask(t, s) if (s := find(t)) else t for x in b.column(text_at)]
            columns = list(b.columns)
            columns[text_at] = pa.array(new, b.schema.types[text_at])
            if n_at is not None:
                sizes = [o if t is None else len(t) for t, o in zip(new, b.column(n_at).to_pylist())]
                columns[n_at] = pa.array(sizes, b.schema.types[n_at])
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
