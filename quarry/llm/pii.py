"""Personal data by anchor expansion.

One Aho-Corasick pass over the text finds anchors: at-signs, plus signs, scheme marks,
digits, and cues such as "iban" or "token".  At each anchor a local parser reads to the
left and right, settles the boundaries and validates what it found; nothing else of the
text is looked at twice.  Per kind the spans are the leftmost, non-overlapping ones, and a
candidate that fails its validation is dropped and not tried again at another place.

email   local part @ labels; the part is all of its characters left of the at-sign
ip      four dotted runs of digits, each at most 255
card    digits with single spaces or hyphens between, 13 to 19 of them, Luhn
phone   plus sign, 9 to 15 digits with spaces, dots, hyphens, brackets between
url     scheme :// up to white space, quotes or angle brackets (added by this method)
account identifier after an account cue; IBANs by their check digits (added)
secret  long token after a credential cue (added)

Positions are code points, ends exclusive.  Defined results: null as empty text; texts
without findings read zero counts, the sha256 of the empty string and empty spans; whole
texts of any length; equal rows give equal results.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import text_udf, whole_text

BASE = ("email", "ip", "card", "phone")
ADDED = ("url", "account", "secret")
ACCOUNT_CUES = ("iban", "account", "acct", "passport", "ssn")
SECRET_CUES = ("token", "secret", "password", "api_key", "apikey")
FIELDS = {"n_email": "long", "n_ip": "long", "n_card": "long", "n_phone": "long",
          "base_sha256": "string", "spans": "string"}

DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
URL = re.compile(r"://[^\s<>\"'`]+")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
ACCOUNT = re.compile(r"(?:[ _-]?(?:number|no|nr|id))?[\s:#=.\"']{1,4}([A-Za-z0-9](?:[ -]?[A-Za-z0-9]){5,33})(?![A-Za-z0-9])")
SECRET = re.compile(r"[\s:=\"']{1,5}([A-Za-z0-9_+/=-]{16,})")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def iban(s: str) -> bool:
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", s):
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


class Finder:
    def __init__(self):
        import ahocorasick

        self.anchors = ahocorasick.Automaton()
        for word, kind in [("@", "email"), ("+", "phone"), ("://", "url")] + [(str(d), "digit") for d in range(10)]:
            self.anchors.add_word(word, (kind, len(word)))
        for kind, cues in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
            for cue in cues:
                for form in {cue, cue.upper(), cue.capitalize()}:
                    self.anchors.add_word(form, (kind, len(form)))
        self.anchors.make_automaton()

    def __call__(self, text: str) -> dict[str, list[tuple[int, int]]]:
        """Spans by kind, in order of their starts."""
        spans: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE + ADDED}
        past = dict.fromkeys(spans, 0)  # where the last candidate of a kind ended
        failed = 0  # where the last run of characters that is no secret ended

        def keep(kind: str, start: int, end: int, valid: bool) -> None:
            past[kind] = end
            if valid:
                spans[kind].append((start, end))

        for end, (kind, size) in self.anchors.iter(text):
            at = end + 1 - size
            if kind == "digit":
                if at >= past["card"] and (m := CARD.match(text, at)):
                    digits = re.sub("[ -]", "", m[0]) if len(m[0]) <= 37 else ""
                    keep("card", at, m.end(), 13 <= len(digits) <= 19 and luhn(digits))
                if at >= past["ip"] and (at == 0 or not "0" <= text[at - 1] <= "9") and (m := IP.match(text, at)):
                    keep("ip", at, m.end(), all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")))
            elif kind == "email":
                if m := DOMAIN.match(text, at):
                    start = at
                    while start > past["email"] and text[start - 1] in LOCAL:
                        start -= 1
                    if start < at:
                        keep("email", start, m.end(), True)
            elif kind == "phone":
                if at >= past["phone"] and (m := PHONE.match(text, at)):
                    digits = sum("0" <= c <= "9" for c in m[0])
                    keep("phone", at, m.end(), 9 <= digits <= 15)
            elif kind == "url":
                start = at
                while start > past["url"] and text[start - 1] in SCHEME:
                    start -= 1
                while start < at and not text[start].isalpha():
                    start += 1
                # the rest is read only behind a scheme, so never twice
                if start < at and at >= past["url"] and (m := URL.match(text, at)):
                    stop = at + len(m[0].rstrip(".,;:!?)]}"))
                    if stop > at + 3:
                        keep("url", start, stop, True)
            elif at >= past[kind] and end + 1 >= failed and (at == 0 or not text[at - 1].isalnum()):
                if m := (ACCOUNT if kind == "account" else SECRET).match(text, end + 1):
                    found = m[1]
                    plain = re.sub("[ -]", "", found)
                    digits = sum("0" <= c <= "9" for c in plain)
                    valid = (iban(plain) or digits >= 6 and digits * 2 >= len(plain)) if kind == "account" \
                        else digits > 0 and any(c.isalpha() for c in found)
                    if valid:
                        keep(kind, m.start(1), m.end(1), True)
                    elif kind == "secret":
                        failed = m.end(1)  # no part of a run without digits or letters is valid
        return spans


def summary(spans: dict[str, list[tuple[int, int]]]) -> tuple[int, int, int, int, str, str]:
    def listed(kinds) -> str:
        return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])

    return (*(len(spans[k]) for k in BASE),
            hashlib.sha256(listed(BASE).encode()).hexdigest(), listed(BASE + ADDED))


def find_documents(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans of every row; no shuffle."""
    def setup():
        finder = Finder()
        return lambda texts: [summary(finder(t)) for t in texts]

    return docs.select(F.col("doc_id"), text_udf(setup, FIELDS)(whole_text()).alias("__r")).select("doc_id", "__r.*")
