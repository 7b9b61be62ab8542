"""Personal data by anchor expansion.

An Aho-Corasick automaton runs once over a whole text and reports *anchors*:
at-signs, scheme separators, plus signs, digits and identifier cues.  Around
each anchor a small deterministic parser expands left and right, fixes the
boundaries and validates what it found (domain labels, octets, Luhn, IBAN
check digits, number of digits).  Nothing else of the text is looked at.

Results per text are spans ``(kind, start, end)`` in code points, end
exclusive, sorted by the order of ``KINDS`` and then by start.  Spans of one
kind never overlap; spans of different kinds may.

Cues are in the corpus's languages (English, German, French, Spanish) and match
in lower, upper, capitalised and title case.  A value is taken up to its own
boundary, however long it is, so that no tail of it stays behind.

Null text gives no spans, like the empty text.  Repeated rows and repeated ids
are scanned each on their own; other columns of the input pass through.  An
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds that this method finds beside the base ones.
ADDED_KINDS = ("spelled_email", "url", "iban", "national_id", "account", "secret", "street")
KINDS = BASE_KINDS + ADDED_KINDS

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType(), False),
    T.StructField("start", T.LongType(), False),
    T.StructField("end", T.LongType(), False),
]), False)

# --- fixed values: cues that announce an identifier, by the parser they call ---
ACCOUNT_CUES = (
    "account no", "account number", "acct", "passport no", "passport number", "member id", "customer id", "patient id",
    "licence number", "license number",
    "konto-nr", "konto nr", "kontonummer", "kundennummer", "kunden-nr", "ausweisnummer", "ausweis-nr", "reisepass-nr",
    "numéro de compte", "n° de compte", "compte n°", "numéro client", "numéro de passeport", "passeport n°",
    "número de cuenta", "n.º de cuenta", "cuenta n.º", "número de cliente", "número de pasaporte", "pasaporte n.º",
)
NATIONAL_CUES = ("ssn", "social security")
INSEE_CUES = ("numéro de sécurité sociale", "n° de sécurité sociale", "sécu", "nir")
DNI_CUES = ("dni", "nif", "nie")
SECRET_CUES = ("token", "api_key", "api key", "apikey", "api-key", "password", "passwd", "secret", "access_key",
               "passwort", "kennwort", "mot de passe", "contraseña")
TOKEN_HEADS = ("ghp_", "gho_", "ghs_", "github_pat_", "glpat-", "xoxb-", "xoxp-", "sk_live_", "AKIA", "AIza")
SPELLED_AT = ("(at)", "[at]", "{at}")
STREET_CUES = (" Street", " Avenue", " Road", " Boulevard", " Lane", " Drive", " Square")
STREET_ENDINGS = ("straße", "strasse", "Straße", "Strasse", "gasse", "allee", "Allee", "platz", "Platz")
STREET_HEADS = ("rue ", "avenue ", "boulevard ", "chemin ", "impasse ", "Calle ", "Avenida ", "Plaza ", "Paseo ")
STREET_LINKS = ("de la ", "de los ", "de las ", "de l'", "de ", "du ", "des ", "del ", "d'", "la ", "le ", "les ", "el ")
IBAN_CUES = ("iban",)
DNI_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
# -------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_WORD = re.compile(r"\w")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_OCTETS = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_DIGIT_RUN = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SCHEME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_URL_REST = re.compile(r"(?:[^\s/?#\"'<>@]*@)?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*|\[[0-9A-Fa-f:.]+\])(?::[0-9]{1,5})?(?:[/?#][^\s\"'<>]*)?")
_IBAN = re.compile(r"[\s:#]{0,3}([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30})")
_NATIONAL = re.compile(r"[^0-9\n]{0,12}([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")
_INSEE = re.compile(r"[\s.:#=]{0,4}([12](?: ?[0-9]){4} ?(?:[0-9] ?[0-9]|2 ?[AB])(?: ?[0-9]){6} ?[0-9] ?[0-9])(?![0-9])")
_DNI = re.compile(r"[\s.:#=/-]{0,4}((?:[0-9]{8}|[XYZxyz]-?[0-9]{7})-?[A-Za-z])(?![A-Za-z0-9])")
# blocks of digits between single spaces or hyphens, or one token of letters, digits and single hyphens, to its end
_ACCOUNT = re.compile(r"[\s.:#=]{1,4}([0-9]{2,}(?:[ -][0-9]{2,})+(?![A-Za-z0-9]|-[A-Za-z0-9])|[A-Za-z0-9](?:-?[A-Za-z0-9]){4,}+)")
_SECRET = re.compile(r"(\s{0,3}[:=]\s{0,3})[\"']?([A-Za-z0-9_./+=-]{8,})")
_TOKEN = re.compile(r"[A-Za-z0-9_-]{16,}")
_SPELLED_DOMAIN = re.compile(r"\s?([A-Za-z0-9-]+(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\})\s?[A-Za-z0-9-]+)+)")
_HOUSE_AFTER = re.compile(r",? ([0-9]{1,5}[A-Za-z]?)(?![A-Za-z0-9])")
_CAPITALISED = re.compile(r"[^\W\d_a-z][^\W\d_]*(?:['-][^\W\d_]+)*")


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def _iban(value: str) -> bool:
    value = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _insee(value: str) -> bool:
    """French number: the two last digits are 97 less the rest modulo 97 (Corsica: 2A is 19, 2B is 18)."""
    value = value.replace(" ", "").replace("2A", "19").replace("2B", "18")
    return 97 - int(value[:-2]) % 97 == int(value[-2:])


def _dni(value: str) -> bool:
    """Spanish number: the letter is the number modulo 23 (foreigners: X, Y, Z stand for 0, 1, 2)."""
    value = value.replace("-", "").upper()
    digits = value[:-1].translate(str.maketrans("XYZ", "012"))
    return DNI_LETTERS[int(digits) % 23] == value[-1]


def _capitalised(word: str) -> bool:
    return word.isalpha() and word[0].isupper() and (len(word) == 1 or word[1:].islower())


def _house_before(text: str, at: int, floor: int) -> int | None:
    """Start of a house number (one to five digits, perhaps a letter) that ends at ``at``."""
    k = at
    if k > floor and text[k - 1].isascii() and text[k - 1].isalpha():
        k -= 1
    start = k
    while start > floor and k - start < 6 and "0" <= text[start - 1] <= "9":
        start -= 1
    return start if 1 <= k - start <= 5 and not (start and text[start - 1].isalnum()) else None


def build_anchors() -> ahocorasick.Automaton:
    """The automaton over all anchors; values are parser names."""
    found: dict[str, str] = {"@": "email", "+": "phone", "://": "url"}
    found |= {d: "digit" for d in "0123456789"}
    for cues, parser in ((ACCOUNT_CUES, "account"), (NATIONAL_CUES, "national_id"), (INSEE_CUES, "insee"), (DNI_CUES, "dni"),
                         (SECRET_CUES, "secret"), (IBAN_CUES, "iban")):
        for cue in cues:
            found |= {form: parser for form in (cue, cue.capitalize(), cue.title(), cue.upper())}
    found |= dict.fromkeys(SPELLED_AT, "spelled_email") | dict.fromkeys(TOKEN_HEADS, "token")
    found |= (dict.fromkeys(STREET_CUES, "street") | dict.fromkeys(STREET_ENDINGS, "street_then_house")
              | dict.fromkeys(STREET_HEADS, "street_named"))
    a = ahocorasick.Automaton()
    for cue, parser in found.items():
        a.add_word(cue, (parser, len(cue)))
    a.make_automaton()
    return a


class Scanner:
    """Scans one text after another; holds the automaton."""

    def __init__(self) -> None:
        self.anchors = build_anchors()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
        #: up to where each kind has consumed the text, matches that failed validation included
        done = dict.fromkeys((*KINDS, "token"), 0)
        for last, (parser, size) in self.anchors.iter(text):
            if parser == "digit":
                if last >= done["ip"]:
                    self._ip(text, last, done, out)
                if last >= done["card"]:
                    self._card(text, last, done, out)
            else:
                getattr(self, f"_{parser}")(text, last + 1 - size, last + 1, done, out)
        return [(k, s, e) for k in KINDS for s, e in sorted(out[k])]

    @staticmethod
    def _ip(text, at, done, out):
        m = _OCTETS.match(text, at)
        if m is None:  # no later start within the same run of digits can match either
            done["ip"] = _DIGIT_RUN.match(text, at).end()
            return
        done["ip"] = m.end()
        if all(map(_octet, m.groups())):
            out["ip"].append(m.span())

    @staticmethod
    def _card(text, at, done, out):
        m = _CARD.match(text, at)
        if m is None:
            done["card"] = at + 1
            return
        done["card"] = m.end()
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out["card"].append(m.span())

    @staticmethod
    def _phone(text, at, _, done, out):
        if at < done["phone"] or (m := _PHONE.match(text, at)) is None:
            return
        done["phone"] = m.end()
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out["phone"].append(m.span())

    @staticmethod
    def _email(text, at, after, done, out):
        start = at
        while start > done["email"] and text[start - 1] in _LOCAL:
            start -= 1
        if start == at or (m := _DOMAIN.match(text, after)) is None:
            return
        done["email"] = m.end()
        out["email"].append((start, m.end()))

    @staticmethod
    def _spelled_email(text, at, after, done, out):
        stop = at - 1 if at and text[at - 1] == " " else at
        start = stop
        while start > done["spelled_email"] and text[start - 1] in _LOCAL:
            start -= 1
        if start == stop or (m := _SPELLED_DOMAIN.match(text, after)) is None:
            return
        done["spelled_email"] = m.end()
        out["spelled_email"].append((start, m.end()))

    @staticmethod
    def _url(text, at, after, done, out):
        start = at
        while start > done["url"] and text[start - 1] in _SCHEME_CHARS:
            start -= 1
        while start < at and not (text[start].isascii() and text[start].isalpha()):
            start += 1
        if start == at or (m := _URL_REST.match(text, after)) is None:
            return
        end = m.end()
        while end > m.end(1) and text[end - 1] in ".,;:!?)":
            end -= 1
        done["url"] = end
        out["url"].append((start, end))

    @staticmethod
    def _iban(text, at, after, done, out):
        if after < done["iban"] or (m := _IBAN.match(text, after)) is None:
            return
        # the greedy value may have run into the next word: the longest prefix with right check digits
        value = m[1]
        for end in range(len(value), 14, -1):
            if value[end - 1] != " " and _iban(value[:end]):
                done["iban"] = m.start(1) + end
                out["iban"].append((m.start(1), m.start(1) + end))
                return

    @staticmethod
    def _after_cue(kind, pattern, text, at, after, done, out, valid=lambda v: True):
        if after < done[kind] or (at and _WORD.match(text, at - 1)) or (m := pattern.match(text, after)) is None:
            return
        if valid(m[1]):
            done[kind] = m.end(1)
            out[kind].append(m.span(1))

    def _national_id(self, text, at, after, done, out):
        self._after_cue("national_id", _NATIONAL, text, at, after, done, out)

    def _insee(self, text, at, after, done, out):
        self._after_cue("national_id", _INSEE, text, at, after, done, out, _insee)

    def _dni(self, text, at, after, done, out):
        self._after_cue("national_id", _DNI, text, at, after, done, out, _dni)

    def _account(self, text, at, after, done, out):
        self._after_cue("account", _ACCOUNT, text, at, after, done, out, lambda v: sum(c.isdigit() for c in v) >= 5)

    @staticmethod
    def _secret(text, at, after, done, out):
        if after < done["secret"] or (at and _WORD.match(text, at - 1)) or (m := _SECRET.match(text, after)) is None:
            return
        # a bare assignment (``password=...``) needs no digit; after a colon or spaces a word may be prose
        if m[1] == "=" or any(c.isdigit() for c in m[2]):
            done["secret"] = m.end(2)
            out["secret"].append(m.span(2))

    @staticmethod
    def _token(text, at, after, done, out):
        """A token that its own head gives away, with or without a cue."""
        if at < max(done["secret"], done["token"]) or (at and _WORD.match(text, at - 1)) or (m := _TOKEN.match(text, at)) is None:
            return
        done["token"] = m.end()
        if any(c.isdigit() for c in text[after:m.end()]):
            done["secret"] = m.end()
            out["secret"].append(m.span())

    @staticmethod
    def _street(text, at, after, done, out):
        """``12 Long Street``: at most four capitalised words, however long, after a house number."""
        if after < len(text) and text[after].isalnum():
            return
        stop = at
        for _ in range(4):
            start = stop
            while start > done["street"] and text[start - 1].isalpha():
                start -= 1
            if start == stop or start <= done["street"] or text[start - 1] != " " or not _capitalised(text[start:stop]):
                return
            stop = start - 1
            house = _house_before(text, stop, done["street"])
            if house is not None:
                done["street"] = after
                out["street"].append((house, after))
                return

    @staticmethod
    def _street_then_house(text, at, after, done, out):
        """``Hauptstraße 12``, ``Lange Straße 3a``: a capitalised name, then the house number."""
        if at < done["street"] or (m := _HOUSE_AFTER.match(text, after)) is None:
            return
        start = at
        while start > done["street"] and (text[start - 1].isalpha() or text[start - 1] == "-"):
            start -= 1
        if start == at:  # the word stands alone: the one before it is its name
            if start <= done["street"] or text[start - 1] != " ":
                return
            start -= 1
            while start > done["street"] and (text[start - 1].isalpha() or text[start - 1] == "-"):
                start -= 1
        if text[start].isupper():
            done["street"] = m.end()
            out["street"].append((start, m.end()))

    @staticmethod
    def _street_named(text, at, after, done, out):
        """``12 rue de la Paix``, ``Calle Mayor 5``: a name of up to four capitalised words and
        small words between, and a house number on either side."""
        if at < done["street"] or (at and _WORD.match(text, at - 1)):
            return
        end, pos = None, after
        for _ in range(4):
            for link in STREET_LINKS:
                if text.startswith(link, pos):
                    pos += len(link)
                    break
            m = _CAPITALISED.match(text, pos)
            if m is None:
                break
            end = m.end()
            if not text.startswith(" ", end):
                break
            pos = end + 1
        if end is None:
            return
        stop = at
        for gap in (", ", " "):
            if text.endswith(gap, 0, at):
                stop = at - len(gap)
                break
        house = _house_before(text, stop, done["street"]) if stop < at else None
        behind = _HOUSE_AFTER.match(text, end)
        if house is None and behind is None:
            return
        start, end = (house, end) if house is not None else (at, behind.end())
        done["street"] = end
        out["street"].append((start, end))


def _find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    scanner = Scanner()
    for texts in batches:
        yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in scanner.spans(t)] if t else [] for t in texts],
                        index=texts.index, dtype=object)


def pii_spans(text: Column) -> Column:
    """Array of ``struct<kind, start, end>`` for a text column."""
    return F.pandas_udf(_find, SPANS)(text.cast("string"))


def find_pii(df: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``df`` with the spans of each whole text in ``out_col``; no shuffle."""
    return df.withColumn(out_col, pii_spans(F.col(text_col)))


def redact(df: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """``df`` with each span of the given kinds replaced by ``[KIND]``
    (overlapping spans by the mark of the one that starts first)."""
    def cut(texts: pd.Series) -> pd.Series:
        scanner = Scanner()

        def one(t):
            if not t:
                return t
            parts, at = [], 0
            for s, e, k in sorted((s, -e, k) for k, s, e in scanner.spans(t) if k in kinds):
                if s >= at:
                    parts += [t[at:s], f"[{k.upper()}]"]
                at = max(at, -e)
            return "".join([*parts, t[at:]])
        return texts.map(one)
    return df.withColumn(text_col, F.pandas_udf(cut, T.StringType())(F.col(text_col).cast("string")))


def pii_digest(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: counts of the base kinds, a digest of the base spans and
    all spans as one string."""
    found = documents.select(F.col(id_col), pii_spans(F.col(text_col)).alias("__spans"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("__spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col(id_col), *(of(k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(joined(F.filter("__spans", lambda s: s["kind"].isin(*BASE_KINDS))).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("__spans")).alias("spans"), F.size("__spans").cast("long").alias("n_spans"))
