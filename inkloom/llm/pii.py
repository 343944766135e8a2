"""Personal data: patterns propose, checksums confirm, context adjusts the score.

Four kinds have a fixed definition and are always reported. Three more are reported
when their score reaches THRESHOLD: IBANs, confirmed by mod-97; American social security
numbers, confirmed by the number ranges in use; and secrets: private keys between their
PEM lines, confirmed by what the first bytes say; tokens and keys, runs of letters and digits
of any length, confirmed by their entropy; and shorter values behind "password:" and the
like, confirmed by the kinds of characters they mix. Without a context word near
them, numbers of the last two kinds are not reported, but for secrets whose own prefix
tells what they are.
"""

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from inkloom.llm.common import documents

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "secret")
THRESHOLD = 0.6
#: Code points before and after a span in which context words count.
CONTEXT = 60

# Prior score of a pattern, what a checksum adds, what a context word adds.
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.4, "phone": 0.5, "iban": 0.3, "ssn": 0.3, "secret": 0.2}
CHECKSUM = {"card": 0.4, "iban": 0.5, "ssn": 0.1, "secret": 0.3}
NEARBY = 0.2
#: What a secret's own prefix adds, and the bits a character that its entropy must have.
PREFIXED, SECRET_BITS = 0.3, 3.0
# Context words by kind.
CONTEXT_WORDS = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "credit", "debit", "mastercard", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security"),
    "secret": ("token", "secret", "password", "passwd", "pwd", "key", "apikey", "api_key", "access_key", "secret_key", "access_token", "auth_token", "auth", "bearer", "credential", "credentials", "passphrase", "passcode", "passwort", "contraseña"),
}
# Length of an IBAN by country, all that use one.
IBAN_LENGTH = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
IBAN_REST = {n: re.compile(rf"(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n in set(IBAN_LENGTH.values())}
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
DIGIT = re.compile(r"[0-9]")
LETTER = re.compile(r"[A-Za-z]")
SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])")
# The lines around private keys, and how their bodies begin: as a DER sequence, or with the name of a format, maybe behind headers.
PEM_OPENS = "-----BEGIN "
PEM_HEAD = re.compile(r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY(?: BLOCK)?-----")
PEM_TAIL = re.compile(r"-----END (?:[A-Z0-9]+ ){0,3}PRIVATE KEY(?: BLOCK)?-----")
PEM_START = r"\s*(?:[A-Za-z-]+:[^\n]*\s+)*(?:MI|MC|MF|MH|MG|b3BlbnNzaC1rZXk|l[A-Za-z0-9+/])"
PEM_BODY = re.compile(PEM_START + r"[A-Za-z0-9+/=\s]*\Z")
PEM_LINES = re.compile(PEM_START + r"[A-Za-z0-9+/]*+={0,2}(?:\s*?\n[ \t]*[A-Za-z0-9+/]++={0,2}(?=\s*(?:\n|\Z)))*")
#: A value behind the name of a secret, its least length, and the bits a character that it must have.
NAMED = re.compile(r"(?i)\b(pass(?:word|wd|phrase|code)|pwd|secret|api[_-]?key|passwort|contraseña)\b[\"']?\s?[:=]\s?[\"']?([^\s\"']++)")
NAMES = ("pass", "pwd", "secret", "api", "contraseña")
VALUE_KINDS = (re.compile("[a-z]"), re.compile("[A-Z]"), DIGIT, re.compile("[^A-Za-z0-9]"))
LEAST_PASSWORD, PASSWORD_BITS = 6, 2.0
# How secrets of well-known services begin.
SECRET_PREFIX = re.compile(r"-----BEGIN |AKIA[0-9A-Z]|gh[opsur]_|github_pat_|xox[abprs]-|sk-|sk_live_|glpat-|eyJ")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(code: str) -> bool:
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping; goes from @ to @, so that long words without one cost nothing."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            floor = m.end()
        at = text.find("@", max(at + 1, floor))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m.group().split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 8 <= len(DIGIT.findall(m.group())) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """As long as the country has them, whatever capitals or digits follow behind a space."""
    floor = 0
    for head in IBAN_HEAD.finditer(text):
        length = IBAN_LENGTH.get(head.group()[:2])
        rest = IBAN_REST[length].match(text, head.end()) if length and head.start() >= floor else None
        if rest and mod97((head.group() + rest.group()).replace(" ", "")):
            yield head.start(), rest.end()
            floor = rest.end()


def ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.span()


def bits(own: str) -> float:
    """Entropy of a character."""
    n = len(own)
    return -sum(k / n * math.log2(k / n) for k in Counter(own).values())


def tokens(text: str) -> Iterator[tuple[int, int]]:
    for m in SECRET.finditer(text):
        own = m.group()
        if DIGIT.search(own) and LETTER.search(own) and bits(own) >= SECRET_BITS:
            yield m.span()


def private_keys(text: str) -> Iterator[tuple[int, int]]:
    """A key with both of its lines; where the last one is missing, as far as its own lines go. Its body starts as every encoded key
    does, or names its own format."""
    at, tail, more = text.find(PEM_OPENS), None, True
    while at >= 0:
        end = at + 1
        if head := PEM_HEAD.match(text, at):
            if more and (tail is None or tail.start() < head.end()):
                tail = PEM_TAIL.search(text, head.end())
                more = tail is not None
            opens = text.find(PEM_OPENS, head.end(), tail.start()) if more else 0
            if more and opens < 0 and PEM_BODY.match(text, head.end(), tail.start()):
                end = tail.end()
                yield at, end
            elif lines := PEM_LINES.match(text, head.end()):
                end = lines.end()
                yield at, end
        at = text.find(PEM_OPENS, end)


def named(text: str) -> bool:
    """Whether NAMED can match at all: most texts have no such word, which costs less to see than the pattern."""
    small = text.lower()
    return any(w in small for w in NAMES)


def passwords(text: str) -> Iterator[tuple[int, int]]:
    """The value behind a name that says so: at least two kinds of characters out of small and capital letters, digits and signs, and not one over and over."""
    for m in NAMED.finditer(text) if named(text) else ():
        own = m[2].rstrip(".,;:!?)]}\"'")
        kinds = sum(bool(p.search(own)) for p in VALUE_KINDS)
        if len(own) >= LEAST_PASSWORD and kinds >= 2 and bits(own) >= PASSWORD_BITS:
            yield m.start(2), m.start(2) + len(own)


def secrets(text: str) -> Iterator[tuple[int, int]]:
    """By start, of those that overlap the first: keys, then tokens, then named values."""
    taken: list[tuple[int, int]] = []
    for some in (private_keys, tokens, passwords):
        free = sorted(taken)
        starts = [a for a, _ in free]
        for a, b in some(text):
            k = bisect.bisect_left(starts, b)
            if not k or free[k - 1][1] <= a:
                taken.append((a, b))
    yield from sorted(taken)


def score(kind: str, text: str, start: int, end: int) -> float:
    around = f"{text[max(0, start - CONTEXT) : start]} {text[end : end + CONTEXT]}".lower()
    words = {w.strip("-") for w in re.findall(r"[^\W\d_][\w-]*", around)}
    known = PREFIXED * (kind == "secret" and SECRET_PREFIX.match(text, start) is not None)
    return round(min(1.0, PRIOR[kind] + CHECKSUM.get(kind, 0.0) + known + NEARBY * (not words.isdisjoint(CONTEXT_WORDS[kind]))), 3)


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in the order of the kinds, then of start; code points, end exclusive."""
    text = text or ""
    found = []
    if "@" in text:
        found += [("email", *s) for s in emails(text)]
    if DIGIT.search(text):
        if text.count(".") >= 3:
            found += [("ip", *s) for s in ips(text)]
        found += [("card", *s) for s in cards(text)]
        if "+" in text:
            found += [("phone", *s) for s in phones(text)]
        found += [("iban", *s) for s in ibans(text)]
        found += [("ssn", *s) for s in ssns(text)]
    if DIGIT.search(text) or PEM_OPENS in text or named(text):
        found += [("secret", *s) for s in secrets(text)]
    scored = [(k, s, e, score(k, text, s, e)) for k, s, e in found]
    return [x for x in scored if x[0] in BASE_KINDS or x[3] >= THRESHOLD]


def pii_spans(docs: DataFrame) -> DataFrame:
    """doc_id and spans, an array of (kind, start, end, score), for every row of docs (doc_id, text).

    A null or empty text has no spans, a row without doc_id no row. Long texts are read whole, in time that grows with
    their length, and no span is too long to be found. Rows that repeat a doc_id each get a row.
    """

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find_spans(t)] for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "spans": spans})

    return documents(docs).mapInPandas(scan, "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint, score: double>>")
