"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits, schemes and
identifier cues. From each anchor a local parser expands to the boundaries of an email address,
an IP address, a card, phone or account number, or a web address, and validates it. A parser
never leaves the run of characters its kind allows, so the work stays linear in the text.

Kinds ``email ip card phone`` are the base set; ``url`` (scheme anchors, a host with a dot) and
``account`` (a cue word followed by an identifier with at least four digits, or a valid IBAN
after the cue ``iban``) are added by the method and never replace a base span.

Defined results: a null text counts as empty and has no spans; a null id is handed on; repeated
rows are scanned one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from deskloom.llm.common import pick

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account")

# fixed values: characters of the local part, the patterns that follow an anchor, cue words
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
GROUPED = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
DIALLED = re.compile(r"[0-9][\x20().0-9-]+[0-9]")
ADDRESS = re.compile(r"[^\s<>\"'`{}|\\^]+")
HOST = re.compile(r"[^\s<>\"'`{}|\\^/?#]*")
IDENTIFIER = re.compile(r"[\x20\t]*(?:no\.?|nr\.?|number)?[\x20\t]*[:#=]?[\x20\t]*([A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)")
IBAN = re.compile(r"[\x20\t]*[:#=]?[\x20\t]*([A-Za-z]{2}[0-9]{2}(?:\x20?[A-Za-z0-9]){10,30})")
SCHEMES = ("http://", "https://", "ftp://")
CUES = ("account", "acct", "konto", "cuenta", "compte", "passport", "iban")


def anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for mark in "@+0123456789":
        automaton.add_word(mark, ("@" if mark == "@" else "+" if mark == "+" else "digit", 1))
    for word, kind in [(w, "url") for w in SCHEMES] + [(w, "iban" if w == "iban" else "account") for w in CUES]:
        for form in {word, word.upper(), word.capitalize()}:
            automaton.add_word(form, (kind, len(form)))
    automaton.make_automaton()
    return automaton


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def valid_iban(value: str) -> bool:
    turned = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _ascii_digits(value: str) -> str:
    return re.sub("[^0-9]", "", value)


def _account(text: str, start: int, end: int, kind: str) -> tuple[int, int] | None:
    """The identifier after the cue at ``start:end``."""
    if start and text[start - 1].isalnum() or kind == "account" and text[end : end + 1].isalpha():
        return None
    if kind == "account":
        found = IDENTIFIER.match(text, end)
        return found.span(1) if found and len(_ascii_digits(found[1])) >= 4 else None
    found = IBAN.match(text, end)
    if not found:
        return None
    value = found[1]
    # the shortest boundary that validates, so that a following word is not taken in
    for size in range(14, len(value) + 1):
        plain = value[:size].replace(" ", "")
        if len(plain) >= 15 and value[size - 1] != " " and value[size : size + 1] in ("", " ") and valid_iban(plain):
            return found.start(1), found.start(1) + size
    return None


def find_spans(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points; base kinds as leftmost matches that do not overlap."""
    spans: list[tuple[int, int, str]] = []
    past = dict.fromkeys(("@", "dotted", "grouped", "+", "url", "account"), 0)
    for last, (kind, size) in automaton.iter(text):
        at = last - size + 1
        if kind == "digit":
            if at >= past["dotted"]:
                chain = DOTTED.match(text, at)
                past["dotted"] = chain.end()
                parts = [m.span() for m in re.finditer("[0-9]+", chain[0])]
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i : i + 4]
                    if all(e - s < 4 or not chain[0][s:e].lstrip("0")[3:] for s, e in four) and all(
                        int(chain[0][s:e]) <= 255 for s, e in four
                    ):
                        spans.append((at + four[0][0], at + four[3][1], "ip"))
            if at >= past["grouped"]:
                chain = GROUPED.match(text, at)
                past["grouped"] = chain.end()
                if len(chain[0]) >= 12 and 12 <= len(digits := _ascii_digits(chain[0])) <= 19 and luhn(digits):
                    spans.append((at, chain.end(), "card"))
        elif kind == "@":
            start = at
            while start > past["@"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (domain := DOMAIN.match(text, at + 1)):
                spans.append((start, domain.end(), "email"))
                past["@"] = domain.end()
        elif kind == "+":
            if at >= past["+"] and (number := DIALLED.match(text, at + 1)):
                past["+"] = number.end()
                if 9 <= len(_ascii_digits(number[0])) <= 15:
                    spans.append((at, number.end(), "phone"))
        elif kind == "url":
            # the host alone is looked at first: a run of schemes without one is passed in linear time
            if at >= past["url"] and "." in HOST.match(text, last + 1)[0].strip("."):
                rest = ADDRESS.match(text, last + 1)
                end = last + 1 + len(rest[0].rstrip(".,;:!?)]"))
                host = re.split("[/?#]", text[last + 1 : end], maxsplit=1)[0]
                if "." in host.strip("."):
                    spans.append((at, end, "url"))
                    past["url"] = end
        elif at >= past["account"] and (found := _account(text, at, last + 1, kind)):
            spans.append((*found, "account"))
            past["account"] = found[1]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kinds, starts, ends (arrays in span order) per document; rows stay where they are."""
    source = pick(docs, doc_id=id_col, text=text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for batch in batches:
            found = [find_spans(t or "", automaton) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([[s[2] for s in spans] for spans in found], pa.list_(pa.string())),
                    pa.array([[s[0] for s in spans] for spans in found], pa.list_(pa.int64())),
                    pa.array([[s[1] for s in spans] for spans in found], pa.list_(pa.int64())),
                ],
                ["doc_id", "kinds", "starts", "ends"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(scan, f"doc_id {kind}, kinds array<string>, starts array<bigint>, ends array<bigint>")


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans the
    one that starts first is named and the others are swallowed."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def sha256_hex(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()
