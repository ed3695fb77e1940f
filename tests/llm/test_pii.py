import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from deskloom.llm.pii import BASE, KINDS, anchors, find_personal_data, find_spans, luhn, redact

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
AUTOMATON = anchors()


def brute(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), m.end(), kind))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def base(text):
    return [s for s in find_spans(text, AUTOMATON) if s[2] in BASE]


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("12.+@a-b() 5é😀\n"), max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert base(text) == brute(text)


def test_known_values():
    text = "é😀 a@b.co, 10.0.0.255 and 256.1.1.1; 4111 1111 1111 1111; +1 (262) 555-3752. "
    text += "see https://x.example.org/a?b. IBAN DE89 3704 0044 0532 0130 00 ok, account no. AB-12345."
    assert base(text) == brute(text)
    got = [(text[s:e], k) for s, e, k in find_spans(text, AUTOMATON)]
    assert ("https://x.example.org/a?b", "url") in got
    assert ("DE89 3704 0044 0532 0130 00", "account") in got and ("AB-12345", "account") in got
    assert "a@b.co" not in redact(text, find_spans(text, AUTOMATON))


def test_long_runs_stay_linear():
    n = 300_000
    text = "a" * n + "@" + "1" * n + "." + "2" * n + "+" + "1 " * n
    assert base(text) == [(0, n + 1 + n + 1 + n, "email")]


def brute_urls(text):
    """Schemes one after another, each with its whole run, as often as it takes."""
    found, past = [], 0
    for m in re.finditer("https?://|ftp://", text, re.IGNORECASE):
        run = re.match(r"[^\s<>\"'`{}|\\^]*", text[m.end() :])[0].rstrip(".,;:!?)]")
        if m.start() >= past and "." in re.split("[/?#]", run)[0].strip("."):
            found.append((m.start(), m.end() + len(run)))
            past = m.end() + len(run)
    return found


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["http://", "https://", "a", ".", "b.c", "/", "?", ")", ",", " ", "<", "é"]), max_size=14))
def test_urls_equal_the_plain_search(parts):
    text = "".join(parts)
    assert [s[:2] for s in find_spans(text, AUTOMATON) if s[2] == "url"] == brute_urls(text)


def test_runs_of_schemes_stay_linear():
    for unit in ("http://", "http://a.)", "https://x/"):
        text = unit * (400_000 // len(unit))
        start = time.perf_counter()
        spans = find_spans(text, AUTOMATON)
        assert time.perf_counter() - start < 5 and len(spans) <= 1


def test_rows(make):
    rows = [(1, None), (None, "x@y.zz"), (3, ""), (3, "1.2.3.4"), (3, "1.2.3.4")]
    got = sorted((r["doc_id"] or 0, list(r["kinds"])) for r in find_personal_data(make(rows)).collect())
    assert got == [(0, ["email"]), (1, []), (3, []), (3, ["ip"]), (3, ["ip"])]
    assert find_personal_data(make([])).count() == 0
