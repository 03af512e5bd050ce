"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in a text: at-signs, plus signs, digits before a dot,
schemes, cue words of identifiers and fixed beginnings of access keys, in any letter case. A small deterministic parser at each anchor expands it to the
boundaries of an address, number or account and validates it. The four base kinds have the meaning
of a leftmost non-overlapping search per kind; the other kinds are found by cues.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tradewake.llm.frames import doc_texts, map_batches

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url_login", "mailbox", "iban", "ssn", "secret")

DIGITS = frozenset(string.digits)
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
LABEL = frozenset(string.ascii_letters + string.digits + "-")
DIALLED = frozenset(string.digits + " ().-")
WORD = frozenset(string.ascii_letters + string.digits)
KEY = WORD | frozenset("_-")
BETWEEN = frozenset(" \"'")
TOKEN = frozenset(string.ascii_letters + string.digits + "_-/+.")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "postgres://", "mysql://")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey", "access_key")
ACCOUNT_CUES = ("iban",)
SOCIAL_CUES = ("ssn", "social security")
# Words that may stand between a cue and its value.
SKIPPED = ("number", "no.", "nr.", "no", "nr", "id", "is", "#")
# Fixed beginnings of access keys, their whole length, and whether they have capitals and digits alone.
KEY_SHAPES = {"akia": (20, True), "asia": (20, True), "ghp_": (40, False), "gho_": (40, False),
              "glpat-": (26, False), "xoxb-": (None, False), "sk_live_": (None, False)}
LEAST_KEY = 24
LOWER = {c: c + 32 for c in range(65, 91)}
MAIL_WORDS = (" at ", "(at)", "[at]")

Span = tuple[str, int, int]


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    anchors = {"@": "at", "+": "plus", **{f"{d}.": "dot" for d in string.digits},
               **{d: "digit" for d in string.digits}}
    for names, what in ((SCHEMES, "scheme"), (SECRET_CUES, "secret"), (ACCOUNT_CUES, "account"),
                        (SOCIAL_CUES, "social"), (MAIL_WORDS, "mail"), (KEY_SHAPES, "key")):
        for name in names:
            anchors[name] = what
    for anchor, what in anchors.items():
        found.add_word(anchor, (what, len(anchor)))
    found.make_automaton()
    return found


def run_end(text: str, at: int, chars: frozenset[str]) -> int:
    size = len(text)
    while at < size and text[at] in chars:
        at += 1
    return at


def run_start(text: str, at: int, chars: frozenset[str], least: int = 0) -> int:
    while at > least and text[at - 1] in chars:
        at -= 1
    return at


def email_at(text: str, at: int, free: int) -> tuple[int, int] | None:
    """Address around the at-sign at ``at``, beginning at ``free`` or later."""
    begin = run_start(text, at, LOCAL, free)
    end = run_end(text, at + 1, LABEL)
    if begin == at or end == at + 1:
        return None
    dots = 0
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in LABEL:
        end, dots = run_end(text, end + 1, LABEL), dots + 1
    return (begin, end) if dots else None


def ip_at(text: str, begin: int) -> tuple[int, bool] | None:
    """End of four dotted numbers from ``begin``, and whether all are at most 255."""
    at, fine = begin, True
    for part in range(4):
        end = run_end(text, at, DIGITS)
        if end == at:
            return None
        number = text[at:end].lstrip("0")
        fine &= len(number) <= 3 and int(number or 0) <= 255
        if part < 3:
            if end >= len(text) or text[end] != ".":
                return None
            at = end + 1
    return end, fine


def number_end(text: str, begin: int) -> int:
    """End of the digits from ``begin`` with single spaces or hyphens between them."""
    at, size = begin + 1, len(text)
    while at < size:
        if text[at] in DIGITS:
            at += 1
        elif text[at] in " -" and at + 1 < size and text[at + 1] in DIGITS:
            at += 2
        else:
            break
    return at


def phone_end(text: str, plus: int) -> int | None:
    if plus + 1 >= len(text) or text[plus + 1] not in DIGITS:
        return None
    end = run_end(text, plus + 2, DIALLED)
    while end > plus + 2 and text[end - 1] not in DIGITS:
        end -= 1
    return end if end >= plus + 4 else None


def digits_of(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(int(d) for d in digits[-1::-2])) % 10 == 0


def _after_cue(text: str, at: int) -> int:
    """Where a value begins behind a cue word: past quotes, spaces, words to skip, one of ``: =``."""
    end = run_end(text, at, BETWEEN)
    skipping = True
    while skipping:
        skipping = False
        for word in SKIPPED:
            past = end + len(word)
            if text[end:past].lower() == word and (not word[-1].isalpha() or text[past:past + 1] not in WORD):
                end, skipping = run_end(text, past, BETWEEN), True
                break
    if end < len(text) and text[end] in ":=":
        end = run_end(text, end + 1, BETWEEN)
    return end


def iban_valid(text: str) -> bool:
    if not (15 <= len(text) <= 34 and text[:2].isalpha() and text[2:4].isdigit()):
        return False
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved.upper())) % 97 == 1


def _cued(text: str, what: str, start: int, end: int) -> Span | None:
    if what == "scheme":
        stop = run_end(text, end, LOCAL | frozenset(":"))
        login = text[end:stop]
        if stop < len(text) and text[stop] == "@" and ":" in login:
            return "url_login", end, stop
    elif what == "mail":
        begin = run_start(text, start, LOCAL)
        stop = run_end(text, end, LABEL)
        for dot in (" dot ", "(dot)", "[dot]"):
            if begin < start and stop > end and text.startswith(dot, stop):
                last = run_end(text, stop + len(dot), LABEL)
                if last > stop + len(dot):
                    return "mailbox", begin, last
    elif what == "account":
        begin = _after_cue(text, end)
        stop, compact = begin, ""
        while stop < len(text) and len(compact) < 34 and \
                (text[stop] in WORD or text[stop] == " " and text[stop + 1:stop + 2] in WORD):
            compact += text[stop].strip()
            stop += 1
            if iban_valid(compact) and text[stop:stop + 1] not in WORD:
                return "iban", begin, stop
    elif what == "social":
        begin = _after_cue(text, end)
        shape = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])").match(text, begin)
        if shape and text[begin:begin + 3] not in ("000", "666") and text[begin] != "9":
            return "ssn", begin, shape.end()
    elif what == "secret":
        begin = _after_cue(text, end)
        stop = run_end(text, begin, TOKEN) if begin > end else begin
        if stop - begin >= 16 and any(c in DIGITS for c in text[begin:stop]):
            return "secret", begin, stop
    elif what == "key":
        size, plain = KEY_SHAPES[text[start:end].lower()]
        stop = run_end(text, end, KEY)
        fits = stop - start == size if size else stop - start >= LEAST_KEY
        key = text[start:stop]
        if fits and text[start - 1:start] not in WORD and any(c in DIGITS for c in key) and (
                not plain or key.isalnum() and key == key.upper()):
            return "secret", start, stop
    return None


def find_spans(text: str) -> list[Span]:
    """All spans by start and then kind; an empty text has none."""
    spans: list[Span] = []
    email_free = ip_free = card_free = phone_free = 0
    # A copy with A-Z in lower case has the same places.
    for last, (what, size) in automaton().iter(text.translate(LOWER)):
        at = last - size + 1
        if what == "digit":
            # One anchor per number: later digits of it lie before ``card_free``.
            if at >= card_free:
                card_free = number_end(text, at)
                digits = digits_of(text[at:card_free])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    spans.append(("card", at, card_free))
        elif what == "dot":
            if at >= ip_free:
                begin = run_start(text, at, DIGITS, ip_free)
                found = ip_at(text, begin)
                if found:
                    ip_free = found[0]
                    if found[1]:
                        spans.append(("ip", begin, ip_free))
        elif what == "at":
            found = email_at(text, at, email_free)
            if found:
                email_free = found[1]
                spans.append(("email", *found))
        elif what == "plus":
            end = phone_end(text, at) if at >= phone_free else None
            if end:
                phone_free = end
                if 9 <= len(digits_of(text[at:end])) <= 15:
                    spans.append(("phone", at, end))
        else:
            found = _cued(text, what, at, last + 1)
            if found:
                spans.append(found)
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _found(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    counts, shas, texts, lists = {k: [] for k in BASE}, [], [], []
    for text in batch.column(1):
        spans = find_spans(text.as_py())
        for kind in BASE:
            counts[kind].append(sum(s[0] == kind for s in spans))
        base = joined([s for s in spans if s[0] in BASE])
        shas.append(hashlib.sha256(base.encode()).hexdigest())
        texts.append(joined(spans))
        lists.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), *(pa.array(counts[k], pa.int64()) for k in BASE),
         pa.array(shas, pa.string()), pa.array(texts, pa.string()), pa.array(lists, pa.list_(span))],
        names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "found"])


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, found: one row per row.

    Spans are in code points, end exclusive. Null and empty texts have none. Repeated rows give
    repeated results, an empty table an empty result; other columns are not looked at.
    """
    return map_batches(
        doc_texts(docs), _found,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
        "spans string, found array<struct<kind: string, start: long, end: long>>")
