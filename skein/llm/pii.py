"""Personal data by anchor expansion.

One Aho-Corasick automaton finds every anchor in a text: at-signs, plus signs,
digits, address schemes and identifier cues.  A deterministic parser then expands
each anchor to its boundaries and validates what it found:

* at-sign: an email (local part to the left, dotted domain to the right);
* digit: the dotted number run (IP addresses, four parts of at most 255) and the
  run of digits with single blanks or hyphens (cards: 12 to 19 digits, Luhn);
* plus sign: an international phone number of 9 to 15 digits;
* scheme: an address `scheme://user:password@host` that carries credentials (`login`);
* identifier cue (account, IBAN, passport, token, ...): the identifier after it, of
  6 to 64 letters and digits with at least 4 digits (`account`; an IBAN must pass
  its check digits).

Anchors come in text order and a parser never reads behind the end of its kind's
last match, so each kind's matches are leftmost and do not overlap.  Spans are in
code points, end exclusive.  Spans of the last two kinds are left out where they
touch one of the first four.

Narrow: one pass, no shuffle; whole texts.  Defined cases: a null or empty text has
no spans; a text of any length is one unit; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame

from .common import map_texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("login", "account")

SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://", "smtp://", "imap://", "jdbc://", "postgres://", "mysql://", "mongodb://")
CUES = ("account", "acct", "konto", "compte", "cuenta", "iban", "passport", "passeport", "pasaporte", "reisepass", "ssn",
        "social security", "tax id", "driver license", "token", "api key", "api_key", "apikey", "secret", "password")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CREDENTIALS = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?")
_AFTER_CUE = re.compile(r"(?:[ ]?(?:number|no\.?|nr\.?|id|key|code))?[ ]?[:=#]?[ ]?[\"']?([A-Za-z0-9]+(?:[-_][A-Za-z0-9]+)*)", re.I)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def iban_valid(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    a.add_word("@", ("@", 1))
    a.add_word("+", ("+", 1))
    for d in "0123456789":
        a.add_word(d, ("0", 1))
    for s in SCHEMES:
        a.add_word(s, ("scheme", len(s)))
    for c in CUES:
        a.add_word(c, ("cue", len(c)))
    a.make_automaton()
    return a


class Finder:
    """Finds the spans of one text."""

    def __init__(self):
        self.anchors = automaton()

    def spans(self, text: str | None) -> list[Span]:
        if not text:
            return []
        # folds A-Z only: positions stay those of the text
        folded = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
        base: list[Span] = []
        more: list[Span] = []
        ends = dict.fromkeys(("email", "dotted", "digits", "phone"), 0)
        for last, (kind, size) in self.anchors.iter(folded):
            if kind == "0":
                if last >= ends["dotted"]:
                    ends["dotted"] = self._dotted(text, last, base)
                if last >= ends["digits"]:
                    ends["digits"] = self._card(text, last, base)
            elif kind == "@":
                ends["email"] = self._email(text, last, ends["email"], base)
            elif kind == "+":
                if last >= ends["phone"]:
                    ends["phone"] = self._phone(text, last, base)
            elif kind == "scheme":
                m = _CREDENTIALS.match(text, last + 1)
                if m:
                    more.append((last + 1 - size, m.end(), "login"))
            else:
                self._account(text, last + 1 - size, last + 1, more)
        if more:
            self._add(base, more)
        base.sort(key=lambda s: (s[0], KINDS.index(s[2])))
        return base

    @staticmethod
    def _email(text: str, at: int, floor: int, out: list[Span]) -> int:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if not m:
            return floor
        out.append((start, m.end(), "email"))
        return m.end()

    @staticmethod
    def _dotted(text: str, at: int, out: list[Span]) -> int:
        m = _DOTTED.match(text, at)
        parts = m.group().split(".")
        start = at
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p := x.lstrip("0")) <= 3 and int(p or "0") <= 255 for x in four):
                out.append((start, end, "ip"))
            start = end + 1
        return m.end()

    @staticmethod
    def _card(text: str, at: int, out: list[Span]) -> int:
        m = _DIGITS.match(text, at)
        if not m:
            return at + 1
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((at, m.end(), "card"))
        return m.end()

    @staticmethod
    def _phone(text: str, at: int, out: list[Span]) -> int:
        m = _PHONE.match(text, at)
        if not m:
            return at
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((at, m.end(), "phone"))
        return m.end()

    @staticmethod
    def _account(text: str, start: int, end: int, out: list[Span]) -> None:
        before = text[start - 1:start]
        if before.isalnum() or before == "_":
            return
        m = _AFTER_CUE.match(text, end)
        if not m:
            return
        iban = _IBAN.match(text, m.start(1))
        if iban and iban_valid(iban.group()):
            out.append((iban.start(), iban.end(), "account"))
            return
        s = m.group(1)
        if 6 <= len(s) <= 64 and sum(c.isdigit() for c in s) >= 4:
            out.append((m.start(1), m.end(1), "account"))

    @staticmethod
    def _add(base: list[Span], more: list[Span]) -> None:
        """Add the spans of `more` that touch no span so far (leftmost first)."""
        taken = sorted((s, e) for s, e, _ in base)
        i, last = 0, 0
        high = 0  # end of the furthest base span that starts before the current one
        for s, e, kind in sorted(more):
            while i < len(taken) and taken[i][0] < s:
                high = max(high, taken[i][1])
                i += 1
            if s >= max(high, last) and not (i < len(taken) and taken[i][0] < e):
                base.append((s, e, kind))
                last = e


_finder: list[Finder] = []


def finder() -> Finder:
    """The automaton, built once per Python worker."""
    if not _finder:
        _finder.append(Finder())
    return _finder[0]


def find_pii(docs: DataFrame, text_col: str = "text", drop_text: bool = False) -> DataFrame:
    """`docs` with `pii_spans`: kind, start, end of every span, in text order."""
    def run(texts):
        f = finder()
        return {"pii_spans": [[{"kind": k, "start": s, "end": e} for s, e, k in f.spans(t)] for t in texts]}

    return map_texts(docs, text_col, run, "pii_spans array<struct<kind:string,start:int,end:int>>", drop_text=drop_text)


def masked(text: str | None, spans: Sequence[Span]) -> str | None:
    """The text with each group of overlapping spans replaced by its first kind in brackets."""
    if not spans:
        return text
    parts, at = [], 0
    i = 0
    while i < len(spans):
        start, end, kind = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][1])
            i += 1
        parts += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join(parts) + text[at:]


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with personal data in the text replaced by its kind in brackets."""
    def run(texts):
        f = finder()
        return {"_masked": [masked(t, f.spans(t)) for t in texts]}

    order = docs.columns
    return map_texts(docs, text_col, run, "_masked string", drop_text=True).withColumnRenamed("_masked", text_col).select(*order)


def digest(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Query columns: counts and the digests of the base spans and of all spans."""
    import hashlib

    def run(texts):
        f = finder()
        out = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
        for t in texts:
            found = f.spans(t)
            for k in BASE_KINDS:
                out[f"n_{k}"].append(sum(s[2] == k for s in found))
            said = [(f"{k}:{s}:{e}", k in BASE_KINDS) for s, e, k in found]
            out["base_sha256"].append(hashlib.sha256(",".join(x for x, b in said if b).encode()).hexdigest())
            out["spans"].append(",".join(x for x, _ in said))
        return out

    return map_texts(docs, text_col, run, "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
                     drop_text=True)
