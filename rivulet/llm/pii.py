"""Format-preserving pseudonyms for personal data (DataFrame operations only).

Validated numbers and dates (and e-mail names) in a text are replaced by a
keyed permutation of their own format, so a card stays a card of the same
length that passes its checksum, and equal values get equal pseudonyms in
every document, however they are punctuated.

===========  ===============================================  =====================
kind         taken if                                         permuted
===========  ===============================================  =====================
card         13-19 digits, plain or grouped by spaces, dots   all but the check digit,
             or dashes, Luhn sum 0                            which is set anew
phone        [+1] (ddd) ddd-dddd or ddd-ddd-dddd; or + and    the digits after the
             a country code with as many digits as numbers    country code
             of that country have, in groups of any size
ssn          ddd-dd-dddd or ddd dd dddd in an assignable      the number among the
             range                                            assignable ones
ipv4         four octets, each at most 255                    the 32 bits
iban         two letters, check digits, mod 97 = 1, all       letters and digits of
             capital or all small letters                     the account; check
                                                              digits set anew
date         a real day 1800-2199: yyyy-mm-dd, yyyy/mm/dd,    the day within those
             dd.mm.yyyy, mm/dd/yyyy, else dd/mm/yyyy          400 years
email        name@host.tld                                    the name's letters and
                                                              digits, each in its class
===========  ===============================================  =====================

Feistel network: the value is halved; each of 10 rounds adds a keyed hash
(SHA-256 of key, kind, round and the right half) to the left half within its
format and swaps. Every round can be undone, so the map is a permutation and
different values of one kind and shape never share a pseudonym. Dates use
the halves 189 x 773 = 146097, the days of 400 years; SSNs 88,902 areas and
groups x 9,999 serial numbers, so every pseudonym is assignable. dd/mm/yyyy is
read only where the month would be over 12; such dates are permuted among
themselves, walking the permutation's cycle until the day is over 12 again. A
pseudonym may by chance equal its value (1 in the size of the format).

Native: split, regexp_extract_all and lambda functions over the matches; a
text without a digit or '@' is passed through unread. There is no shuffle.

A card's or IBAN's longest candidate may end in a neighbour ('4111 1111 1111
1111 12/27', 'AT611904300234573201 EUR'). Texts with such a candidate that
fails its check are read again, one candidate after the other: a card also
without its last group, an IBAN at its country's length (of an unknown
country: up to each of its groups), and what follows the value taken is
searched anew, so a neighbour that is a value itself is found as well. A phone
number ends where its country's do. Where these have several lengths
(``PHONE_SOME``) the longest that ends with a group is taken, so a short number
right after it may be taken into it; of countries not listed, only numbers
written without separators are taken, their first three digits staying.

Defined results. Null text stays null; texts without personal data stay as
they are; overlapping candidates are taken leftmost first, once. Of a card
that is valid with and without its last group the longer one counts; of an
IBAN that of its country's length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import col, fresh

ROUNDS = 10
DEFAULT_KEY = "rivulet-demo-key"  # callers pass their own secret

# The formats looked for. Alternatives are tried in this order
# at every place of a text; none repeats over an unbounded run.
EMAIL = (r"(?<![\p{L}0-9._%+-])[\p{L}0-9][\p{L}0-9._%+-]{0,63}+"
         r"@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])")
IBAN = (r"(?<![A-Za-z0-9])(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
        r"|[a-z]{2}[0-9]{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?)(?![A-Za-z0-9])")
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
DATE = (r"(?<![0-9./-])(?:(?:18|19|20|21)[0-9]{2}(?:-[0-9]{2}-|/[0-9]{2}/)[0-9]{2}"
        r"|[0-9]{2}(?:\.[0-9]{2}\.|/[0-9]{2}/)(?:18|19|20|21)[0-9]{2})(?![0-9]|[./-][0-9])")
SSN = r"(?<![0-9-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{3} [0-9]{2} [0-9]{4})(?![0-9]|-[0-9])"
# Country codes by the digits that follow them; then those of countries whose
# numbers have several lengths.
PHONE_DIGITS = {
    7: "354", 8: "45 47 65 216 370 371 386 852",
    9: "27 31 33 34 40 41 48 56 61 66 94 212 213 254 351 353 380 420 421 886 966 971 972",
    10: "1 7 20 30 44 52 54 57 63 81 90 91 92 98 234", 11: "86"}
PHONE_SOME = "32 36 39 43 46 49 55 60 62 64 82 84 352 358 359 372 385"
PHONE = (r"(?<![0-9+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9]|-[0-9])|"
         + "|".join(r"(?<![0-9+])\+(?:%s)(?:[ .-]?[0-9]){%s}(?![0-9])" % (codes.replace(" ", "|"), n)
                    for n, codes in [*PHONE_DIGITS.items(), ("7,11", PHONE_SOME)])
         + r"|(?<![0-9+])\+[0-9]{9,15}(?![0-9])")
PHONE_CODES = " ".join([*PHONE_DIGITS.values(), PHONE_SOME])
CARD = (r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){2,3}(?: [0-9]{1,3})?"
        r"|[0-9]{4}(?:-[0-9]{4}){2,3}(?:-[0-9]{1,3})?|[0-9]{4}(?:[.][0-9]{4}){2,3}(?:[.][0-9]{1,3})?"
        r"|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5}|[0-9]{4}[.][0-9]{6}[.][0-9]{5})(?![0-9])")
# One look at the next character rules out nearly every place of a text; only
# texts with an '@' are searched for e-mails as well.
NUMBERS = f"(?=[0-9+(])(?:{'|'.join((IPV4, DATE, SSN, PHONE, CARD))})|(?=[A-Z][A-Z][0-9]|[a-z][a-z][0-9]){IBAN}"
WITH_EMAIL = f"{EMAIL}|{NUMBERS}"

# Candidates that may end in a neighbour, and the characters that any candidate
# or its look at the neighbours can hold: none reaches beyond a run of them.
LONG_CARD = ("[0-9]{4}(?: [0-9]{4}){3} [0-9]{1,3}|[0-9]{4}(?:-[0-9]{4}){3}-[0-9]{1,3}"
             "|[0-9]{4}(?:[.][0-9]{4}){3}[.][0-9]{1,3}")
RUN = r"[\p{L}0-9 ._%+@()/-]"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU"}

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# letters beyond ASCII that are permuted in names of e-mail addresses; others stay
_UPPER_MORE = "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7)
_LOWER_MORE = "".join(chr(c) for c in range(0xE0, 0xFF) if c != 0xF7)
_AREAS, _GROUPS, _SERIALS, _WALK = 898, 99, 9_999, 64
_ORIGIN, _DAYS, _DAYS_LEFT, _DAYS_RIGHT = "1800-01-01", 146_097, 189, 773


def let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once, however often f uses it:
    inside a lambda Spark would compute it anew at every use."""
    return F.get(F.transform(F.array(value), lambda v: f(v)), F.lit(0))


def _hash(key: str, kind: str | Column, step: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), value), 256)


def _number(digest: Column) -> Column:
    """The first 60 bits of a hex digest."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _rotate(chars: Column, digest: Column) -> Column:
    """Each letter or digit moved on within its class by its byte of the
    digest; other characters stay."""
    def one(i):
        c = F.substr(chars, i, F.lit(1))
        by = F.conv(F.substr(digest, F.pmod(i - 1, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        moved = c
        for alphabet in (_LOWER, _UPPER, _DIGITS, _LOWER_MORE, _UPPER_MORE):
            at = F.call_function("locate", c, F.lit(alphabet))  # from 1; 0: not in it
            moved = F.when(at > 0, F.substr(F.lit(alphabet),
                                            F.pmod(at - 1 + by, F.lit(len(alphabet))) + 1,
                                            F.lit(1))).otherwise(moved)
        return moved
    return F.when(F.length(chars) > 0, F.array_join(F.transform(
        F.sequence(F.lit(1), F.length(chars)), one), "")).otherwise(chars)


def _rotated(chars: Column, key: str, kind: str, i: Column, other: Column) -> Column:
    return let(_hash(key, kind, i, other), lambda digest: _rotate(chars, digest))


def permute_chars(value: Column, key: str, kind: str | Column) -> Column:
    """Feistel over a string; every character keeps its class. Length 1 is
    rotated by the key alone."""
    return let(value, lambda v: _permute_chars(v, key, kind))


def _permute_chars(value: Column, key: str, kind: str) -> Column:
    half = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), half).alias("l"),
                     F.substr(value, half + 1, F.length(value)).alias("r"))
    # the halves trade places each round but keep their own lengths
    def step(s, i):
        left = F.struct(_rotated(s["l"], key, kind, i, s["r"]).alias("l"), s["r"].alias("r"))
        right = F.struct(s["l"].alias("l"), _rotated(s["r"], key, kind, i, s["l"]).alias("r"))
        return F.when(i % 2 == 0, left).otherwise(right)
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step,
                       lambda s: F.concat(s["l"], s["r"]))


def permute_number(value: Column, left: int | Column, right: int | Column, key: str, kind: str | Column) -> Column:
    """Feistel over 0 .. left * right - 1."""
    left, right = F.lit(left), F.lit(right)
    start = F.struct(F.floor(value / right).cast("bigint").alias("l"),
                     F.pmod(value, right).cast("bigint").alias("r"))

    def step(s, i):
        return F.when(i % 2 == 0, F.struct(
            F.pmod(s["l"] + _number(_hash(key, kind, i, s["r"].cast("string"))) % left,
                   left).cast("bigint").alias("l"), s["r"].alias("r"))).otherwise(F.struct(
                s["l"].alias("l"),
                F.pmod(s["r"] + _number(_hash(key, kind, i, s["l"].cast("string"))) % right,
                       right).cast("bigint").alias("r")))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step,
                       lambda s: s["l"] * right + s["r"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refill(m: Column, chars: Column, cls: str = "[0-9]") -> Column:
    """``m`` with its characters of class ``cls`` replaced, in order, by
    those of ``chars``."""
    def fill(new):
        def step(s, c):
            takes = c.rlike(cls)
            return F.struct(F.concat(s["out"], F.when(takes, F.substr(new, s["at"], F.lit(1)))
                                     .otherwise(c)).alias("out"),
                            (s["at"] + takes.cast("int")).alias("at"))
        return F.aggregate(F.split(m, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
                           step, lambda s: s["out"])
    return let(chars, fill)


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a digit string (a valid one is 0 mod 10)."""
    def total(d):
        n = F.length(d)

        def one(s, i):
            x = F.substr(d, i, F.lit(1)).cast("int")
            return s + F.when((n - i) % 2 == 1, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x)
        return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), one)
    return let(digits, total)


# What a valid match is made of: its kind and either characters (body) or a
# number below left * right. Of all kinds together one permutation each is
# planned, which keeps the expression and the time to build it small.
def _chars(kind: str, body: Column) -> Column:
    return _plan(kind, body, None, 0, 0)


def _value(kind: str | Column, number: Column, left: int, right: int) -> Column:
    return _plan(kind, None, number, left, right)


def _plan(kind, body, number, left: int, right: int) -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(body).cast("string").alias("body"),
                    F.lit(number).cast("bigint").alias("number"), F.lit(left).cast("bigint").alias("left"),
                    F.lit(right).cast("bigint").alias("right"))


def _card(m: Column) -> Column:
    return let(_digits(m), lambda digits: F.when(_luhn(digits) % 10 == 0, _chars(
        "card", F.substr(digits, F.lit(1), F.length(digits) - 1))))


def _card_of(m: Column, body: Column) -> Column:
    return _refill(m, F.concat(body, F.pmod(10 - _luhn(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")))


def _ipv4(m: Column) -> Column:
    return let(F.transform(F.split(m, "[.]"), lambda o: o.cast("bigint")), lambda octets: F.when(
        F.forall(octets, lambda o: o <= 255),
        _value("ipv4", F.aggregate(octets, F.lit(0).cast("bigint"), lambda s, o: s * 256 + o), 1 << 16, 1 << 16)))


def _ipv4_of(n: Column) -> Column:
    return F.array_join(F.array(*[F.pmod(F.shiftright(n, by), F.lit(256)).cast("string") for by in (24, 16, 8, 0)]), ".")


def _origin() -> Column:
    return F.lit(_ORIGIN).cast("date")


def _date(m: Column) -> Column:
    """Kind dmy: a date with slashes whose day comes first."""
    def day(iso):
        return F.call_function("try_to_date", iso, F.lit("yyyy-MM-dd"))
    usual = day(F.when(m.rlike("^[0-9]{4}"), F.regexp_replace(m, "/", "-")).when(
        m.contains("."), F.regexp_replace(m, r"^(..)\.(..)\.(....)$", "$3-$2-$1")).otherwise(
        F.regexp_replace(m, "^(..)/(..)/(....)$", "$3-$1-$2")))
    turned = F.when(m.rlike("^../../....$"), day(F.regexp_replace(m, "^(..)/(..)/(....)$", "$3-$2-$1")))
    return let(F.struct(usual.alias("usual"), turned.alias("turned")), lambda d: F.when(
        F.coalesce(d["usual"], d["turned"]).isNotNull(), _value(
            F.when(d["usual"].isNotNull(), "date").otherwise("dmy"),
            F.datediff(F.coalesce(d["usual"], d["turned"]), _origin()), _DAYS_LEFT, _DAYS_RIGHT)))


def _date_of(m: Column, kind: Column, n: Column) -> Column:
    return let(F.date_add(_origin(), n.cast("int")), lambda d: F.when(
        m.rlike("^[0-9]{4}-"), F.date_format(d, "yyyy-MM-dd")).when(
        m.rlike("^[0-9]{4}/"), F.date_format(d, "yyyy/MM/dd")).when(
        m.contains("."), F.date_format(d, "dd.MM.yyyy")).when(
        kind == "dmy", F.date_format(d, "dd/MM/yyyy")).otherwise(F.date_format(d, "MM/dd/yyyy")))


def _ssn(m: Column) -> Column:
    real = ~m.rlike("^(000|666|9..)|^...[ -]00|0000$")
    area, group, serial = (F.substr(m, F.lit(at), F.lit(n)).cast("bigint") for at, n in ((1, 3), (5, 2), (8, 4)))
    area = area - F.when(area > 666, 2).otherwise(1)  # its number among the assignable ones
    return F.when(real, _value("ssn", (area * _GROUPS + group - 1) * _SERIALS + serial - 1,
                               _AREAS * _GROUPS, _SERIALS))


def _ssn_of(m: Column, n: Column) -> Column:
    area = F.floor(n / (_GROUPS * _SERIALS)).cast("bigint") + 1
    area = area + F.when(area >= 666, 1).otherwise(0)
    group, serial = F.pmod(F.floor(n / _SERIALS).cast("bigint"), F.lit(_GROUPS)) + 1, F.pmod(n, F.lit(_SERIALS)) + 1
    return _refill(m, F.concat(*[F.lpad(x.cast("string"), w, "0") for x, w in ((area, 3), (group, 2), (serial, 4))]))


def _phone(m: Column) -> Column:
    code = F.when(m.startswith("+"), F.regexp_replace(
        _digits(m), f"^({PHONE_CODES.replace(' ', '|')}|...).*$", "$1")).otherwise(
        F.when(F.length(_digits(m)) > 10, "1").otherwise(""))
    return _chars("phone", F.substr(_digits(m), F.length(code) + 1, F.length(m)))


def _phone_of(m: Column, body: Column) -> Column:
    digits = _digits(m)
    return _refill(m, F.concat(F.substr(digits, F.lit(1), F.length(digits) - F.length(body)), body))


def _mod97(chars: Column) -> Column:
    """Value mod 97 of an IBAN string, letters counting 10 to 35."""
    def step(s, c):
        d = F.call_function("locate", c, F.lit(_DIGITS + _UPPER)) - 1
        return F.when(d > 9, (s * 100 + d) % 97).otherwise((s * 10 + d) % 97)
    return F.aggregate(F.split(chars, ""), F.lit(0), step)


def _iban_valid(plain: Column) -> Column:
    return _mod97(F.concat(F.substr(plain, F.lit(5), F.length(plain)), F.substr(plain, F.lit(1), F.lit(4)))) == 1


def _at_country_length(m: Column) -> Column:
    """The part of an IBAN candidate that has its country's length and ends
    with a group; null if there is none or it is the whole."""
    part = F.lit(None).cast("string")
    for n, countries in IBAN_LENGTHS.items():
        part = F.when(F.upper(m).rlike(f"^(?:{countries.replace(' ', '|')})"),
                      F.regexp_substr(m, F.lit(f"^(?:[A-Za-z0-9] ?){{{n - 1}}}[A-Za-z0-9](?= )"))).otherwise(part)
    return part


def _iban(m: Column) -> Column:
    def planned(plain):
        own = F.when(m.contains(" "), F.upper(F.regexp_replace(_at_country_length(m), " ", "")))
        valid = _iban_valid(plain) & ~F.coalesce(_iban_valid(own), F.lit(False))
        return F.when(valid, _chars("iban", F.substr(plain, F.lit(5), F.length(plain))))
    return let(F.upper(F.regexp_replace(m, " ", "")), planned)


def _iban_of(m: Column, account: Column) -> Column:
    country = F.upper(F.substr(m, F.lit(1), F.lit(2)))
    check = F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0")
    new = _refill(m, F.concat(country, check, account), "[A-Za-z0-9]")
    return F.when(m == F.upper(m), new).otherwise(F.lower(new))


def _email(m: Column) -> Column:
    return _chars("email", F.substr(m, F.lit(1), F.call_function("locate", F.lit("@"), m) - 1))


def _email_of(m: Column, name: Column) -> Column:
    return F.concat(name, F.substr(m, F.length(name) + 1, F.length(m)))


def _whole(pattern: str) -> str:
    """The pattern for a match alone: without its look at the neighbours."""
    import re
    bare = re.sub(r"\(\?<!\[[^]]*\]\)|\(\?!\[[^]]*\](?:\|[^()]*)?\)", "", pattern)
    return f"^(?:{bare})$"


def _valid(match: Column, key: str) -> Column:
    """The pseudonym of one match, or null if it isn't valid."""
    return let(match, lambda m: let(_parsed(m), lambda p: F.when(p.isNotNull(), F.coalesce(
        F.when(p["body"].isNotNull(), let(permute_chars(p["body"], key, p["kind"]), lambda new: F.when(
            p["kind"] == "email", _email_of(m, new)).when(p["kind"] == "iban", _iban_of(m, new)).when(
            p["kind"] == "card", _card_of(m, new)).otherwise(_phone_of(m, new)))),
        let(_permuted(p, key), lambda n: F.when(p["kind"] == "ipv4", _ipv4_of(n)).when(
            p["kind"] == "ssn", _ssn_of(m, n)).otherwise(_date_of(m, p["kind"], n)))))))


def _parsed(m: Column) -> Column:
    """Kind and contents of a valid match; the first kind that it fits counts."""
    return F.coalesce(
        F.when(m.contains("@"), _email(m)), F.when(m.rlike(_whole(IBAN)), _iban(m)),
        F.when(m.rlike(_whole(IPV4)), _ipv4(m)), F.when(m.rlike(_whole(DATE)), _date(m)),
        F.when(m.rlike(_whole(SSN)), _ssn(m)), F.when(m.rlike(_whole(CARD)), _card(m)),
        F.when(m.rlike(_whole(PHONE)), _phone(m)))


def _permuted(p: Column, key: str) -> Column:
    """The number's image; of a date of kind dmy the first one on the cycle
    with a day over 12 (of 64 steps in a row all would fail once in 10^26)."""
    def step(n, i):
        fits = (i > 1) & ((p["kind"] != "dmy") | (F.dayofmonth(F.date_add(_origin(), n.cast("int"))) > 12))
        return F.when(fits, n).otherwise(permute_number(n, p["left"], p["right"], key, p["kind"]))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_WALK)), p["number"], step)


def pseudonym(match: Column, key: str = DEFAULT_KEY) -> Column:
    """The pseudonym of one match, or the match itself if it isn't valid."""
    return let(match, lambda m: F.coalesce(_valid(m, key), m))


def _taken(match: Column, key: str) -> Column:
    """value and new: the part of a candidate that is valid, from its start on,
    and its pseudonym; null if there is none."""
    groups = F.split(match, " ")
    known = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
    parts = F.when(match.rlike(f"^(?:{LONG_CARD})$"), F.array(match, F.regexp_replace(match, "[ .-][0-9]+$", ""))).when(
        match.rlike(_whole(IBAN)) & match.rlike(f"^(?:{known})"), F.array(_at_country_length(match), match)).when(
        match.rlike(_whole(IBAN)), F.filter(
            F.transform(F.sequence(F.size(groups), F.lit(1), F.lit(-1)),
                        lambda n: F.array_join(F.slice(groups, F.lit(1), n), " ")),
            lambda p: p.rlike(_whole(IBAN)))).otherwise(F.array(match))
    tried = F.transform(parts, lambda p: F.struct(p.alias("value"), _valid(p, key).alias("new")))
    return F.get(F.filter(tried, lambda t: t["new"].isNotNull()), F.lit(0))


def _read(run: Column, key: str) -> Column:
    """out (the text with its data replaced), n_found and n_replaced of one
    run of characters, read one candidate after the other."""
    def step(s, _):
        def at(place):
            def with_match(m):
                def with_taken(t):
                    return F.struct(
                        F.concat(s["out"], F.substr(s["rest"], F.lit(1), place - 1),
                                 F.coalesce(t["new"], m)).alias("out"),
                        F.substr(s["rest"], place + F.length(F.coalesce(t["value"], m)),
                                 F.length(s["rest"])).alias("rest"),
                        (s["n_found"] + 1).alias("n_found"),
                        (s["n_replaced"] + F.coalesce((t["new"] != t["value"]).cast("int"), F.lit(0)))
                        .alias("n_replaced"))
                return let(_taken(m, key), with_taken)
            return F.when(place > 0, let(F.regexp_substr(s["rest"], F.lit(WITH_EMAIL)), with_match)).otherwise(
                F.struct(F.concat(s["out"], s["rest"]).alias("out"), F.lit("").alias("rest"),
                         s["n_found"].alias("n_found"), s["n_replaced"].alias("n_replaced")))
        return F.when(s["rest"] != "", let(F.regexp_instr(s["rest"], F.lit(WITH_EMAIL)), at)).otherwise(s)
    # each step takes one group at least; the last one finds nothing
    steps = F.sequence(F.lit(1), F.size(F.split(run, r"[^\p{L}0-9]+")) + 1)
    start = F.struct(F.lit("").alias("out"), run.alias("rest"), F.lit(0).alias("n_found"), F.lit(0).alias("n_replaced"))
    return F.aggregate(steps, start, step)


def _again(text: Column, found: Column, new: Column, key: str) -> Column:
    """The runs of the text as ``_read`` leaves them, if a candidate that
    isn't valid may have a neighbour's characters; else null."""
    suspect = F.exists(F.zip_with(found, new, lambda m, n: n.isNull() & (
        m.rlike(f"^(?:{LONG_CARD})$") | (m.contains(" ") & m.rlike(_whole(IBAN))))), lambda x: x)
    runs = F.regexp_extract_all(text, F.lit(f"({RUN}+|[^{RUN[1:]}+)"), F.lit(0))
    return F.when(suspect, F.transform(runs, lambda r: _read(r, key)))


def _found(text: Column) -> Column:
    numbers, all_ = (F.regexp_extract_all(text, F.lit(f"({p})"), F.lit(0)) for p in (NUMBERS, WITH_EMAIL))
    return F.when(text.contains("@"), all_).otherwise(numbers)


def _joined(text: Column, found: Column, new: Column, again: Column) -> Column:
    """The text with its matches replaced by ``new`` where that isn't null."""
    between = F.when(text.contains("@"), F.split(text, WITH_EMAIL, -1)).otherwise(F.split(text, NUMBERS, -1))
    once = F.array_join(F.zip_with(between, F.zip_with(found, new, lambda m, n: F.coalesce(n, m)),
                                   lambda b, m: F.concat(b, F.coalesce(m, F.lit("")))), "")
    return F.when(again.isNotNull(), F.array_join(F.transform(again, lambda r: r["out"]), "")).when(
        F.size(found) > 0, once).otherwise(text)


def _candidates(text: Column) -> Column:
    return F.when(text.rlike("[0-9@]"), _found(text))


def pseudonymise(text: Column, key: str = DEFAULT_KEY) -> Column:
    """The text with its personal data replaced."""
    return let(_candidates(text), lambda found: let(
        F.transform(found, lambda m: _valid(m, key)), lambda new: let(
            _again(text, found, new, key), lambda again: _joined(text, found, new, again))))


def replace(docs: DataFrame, text: str = "text", key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with the personal data in column ``text`` replaced; all
    columns and rows stay, in their order."""
    names = list(docs.columns)
    for n in ("pii_found", "pii_new", "pii_again"):
        names.append(fresh(names, n))
    found, new, again = names[-3:]
    return (docs.withColumn(found, _candidates(col(text)))
            .withColumn(new, F.transform(col(found), lambda m: _valid(m, key)))
            .withColumn(again, _again(col(text), col(found), col(new), key))
            .select(*[_joined(col(text), col(found), col(new), col(again)).alias(c) if c == text
                      else col(c) for c in docs.columns]))


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
           key: str = DEFAULT_KEY) -> DataFrame:
    """doc_id, text (replaced), n_found (candidates, valid or not) and
    n_replaced."""
    def total(field):
        return F.aggregate("again", F.lit(0), lambda n, r: n + r[field])
    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .withColumn("found", _candidates(F.col("text")))
            .withColumn("new", F.transform("found", lambda m: _valid(m, key)))
            .withColumn("again", _again(F.col("text"), F.col("found"), F.col("new"), key))
            .select("doc_id",
                    _joined(F.col("text"), F.col("found"), F.col("new"), F.col("again")).alias("text"),
                    F.coalesce(total("n_found"), F.size("found"), F.lit(0)).cast("long").alias("n_found"),
                    F.coalesce(total("n_replaced"), F.size(F.array_compact(F.zip_with(
                        "found", "new", lambda a, b: F.when(a != b, F.lit(1))))), F.lit(0))
                    .cast("long").alias("n_replaced")))
