"""Personal data by keyed pseudonyms of the same format, in DataFrame functions only.

Cards, bank accounts (IBAN), phone numbers, social security numbers, addresses of hosts and dates go through a keyed
Feistel permutation within their format, so a value always gets the same pseudonym, in any document, and two values
never share one. Mail addresses and assigned secrets get keyed names of the same shape.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Replace it: whoever has the key can undo the permutations.
DEFAULT_KEY = "playstream pseudonyms"
ROUNDS = 8

_MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){0,126}\.[A-Za-z]{2,}+"
#: A name, perhaps in quotes as in JSON, and its value: in quotes, or without them if it holds a digit.
_SECRET_NAME = r"(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?\s?[=:]\s?"
_SECRET = (
    r"(?<![A-Za-z])" + _SECRET_NAME + r"""(?:"[^"\s]{8,}+"|'[^'\s]{8,}+'"""
    r"""|(?=[A-Za-z_+/.~-]*+[0-9])[A-Za-z0-9][A-Za-z0-9_+/.~-]{6,}[A-Za-z0-9_+/~-])"""
)
_HOST = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
#: IPv6: eight groups, or fewer with one ``::`` after a first group of four that holds a digit, as all global, local and
#: link addresses have; names of program parts (``std::vector``) have none.
_HOST6 = (
    r"(?<![A-Za-z0-9:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?=[A-Fa-f]{0,3}[0-9])[0-9A-Fa-f]{4}(?::[0-9A-Fa-f]{1,4}){0,6}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)"
    r"(?![A-Za-z0-9:]|\.[0-9])"
)
#: Characters of an IBAN by country. Fixed values.
_IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


def _iban_pattern() -> str:
    """Country, two check digits and the account, in one piece or in groups of four."""
    forms = []
    for length in sorted(set(_IBAN_LENGTHS.values())):
        countries = "|".join(c for c, n in _IBAN_LENGTHS.items() if n == length)
        groups, rest = divmod(length - 4, 4)
        tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
        forms.append(f"(?:{countries})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}")
    return f"(?<![A-Za-z0-9])(?:{'|'.join(forms)})(?![A-Za-z0-9])"


_IBAN = _iban_pattern()
#: Country codes of one and two digits; all others have three. Fixed values.
_CODE = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
#: Complete, and so not carried on over a space: ten digits after +1, a subscriber number in one piece or with a hyphen,
#: 15 digits. Without a country code: three, three and four digits with the first three in parentheses, or all hyphened.
_PHONE = (
    r"(?<![0-9+])\+(?:1[ .-](?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|[1-9][0-9]{6,14}(?![0-9])"
    r"|[0-9]{1,3}[ .-](?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{6,8}(?![0-9])"
    r"|[0-9]{1,3}[ -](?:\([0-9]{2,4}\)|[0-9]{2,4})[ -][0-9]{2,5}-[0-9]{2,5}(?:-[0-9]{2,5})?(?![0-9]|-[0-9])"
    r"|[0-9]{1,3}[ -](?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ -][0-9]{2,5}){1,3}(?![0-9])(?<![0-9]"
    + "[ ()-]{0,2}[0-9]" * 15
    + "))"
)
_NATIONAL = (
    r"(?<![0-9+][ -]?)\([2-9][0-9]{2}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9]|-[0-9])"
    r"|(?<![0-9.-]|[0-9+] )[2-9][0-9]{2}-[2-9][0-9]{2}-[0-9]{4}(?![0-9]|-[0-9]| [0-9])"
)
_DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9]|[./-][0-9])"
_SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
#: A run of numbers, of which any neighbours may be a card; the first part of a host or date after it is none of it.
_CARD = (
    r"(?<![0-9])(?=(?:[0-9][ -]?){12}[0-9])[0-9][0-9 -]*[0-9](?![0-9])"
    r"(?!(?<=[ -][0-9]{1,3})(?:\.[0-9]{1,3}){3}(?![0-9.]))(?!(?<=[ -][0-9]{2})[./][0-9]{2}[./][0-9]{4}(?![0-9]))"
)
#: Usual ways to group the digits of a card, and first digits with the lengths that issuers give them.
_LAYOUT = r"^(?:[0-9]+|[0-9]{4}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})$"
_ISSUER = (
    r"^(?:4[0-9]{12}(?:[0-9]{3}){0,2}|5[1-5][0-9]{14}|2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)[0-9]{12}"
    r"|3[47][0-9]{13}|3(?:0[0-5]|[689][0-9])[0-9]{11}|6(?:011|4[4-9][0-9]|5[0-9]{2})[0-9]{12}(?:[0-9]{3})?"
    r"|35[0-9]{14}|62[0-9]{14,17})$"
)
#: Most groups in a usual layout; other ways to group a card's digits count only where the card is the whole run.
CARD_GROUPS = 5
_IN_RUN = "|".join((_DATE, _SOCIAL))
PATTERN = "|".join((_MAIL, _SECRET, _IBAN, _HOST6, _HOST, _PHONE, _NATIONAL, _DATE, _SOCIAL, _CARD))
#: What each of the above holds at least; other texts are passed through without a search.
HINT = r"""[0-9@]|[=:]\s?["']"""

KINDS = ("mail", "secret", "iban", "host6", "host", "phone", "date", "social", "card")
#: Dates are permuted among the days of this Gregorian cycle, whose length is 189 * 773 days, and others among the days of
#: their own 400 years before or after; of the years that can be written, the whole cycles end with these.
FIRST_DAY, LAST_DAY, DAY_PARTS = "1800-01-01", "2199-12-31", (189, 773)
EARLIEST_DAY, LATEST_DAY = "0200-01-01", "9799-12-31"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), body)[0]


def _keyed(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)


def _number(hexadecimal: Column) -> Column:
    """The first 60 bits of a digest."""
    return F.conv(F.substring(hexadecimal, 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, tweak: Column) -> Column:
    """Struct of ``l`` and ``r`` permuted within ``[0, left_size) x [0, right_size)``: rounds add to one half what the
    keyed digest of the other half says."""

    def step(state: Column, turn: Column) -> Column:
        to_left = F.pmod(state["l"] + _number(_keyed(key, tweak, turn, state["r"])) % left_size, left_size)
        to_right = F.pmod(state["r"] + _number(_keyed(key, tweak, turn, state["l"])) % right_size, right_size)
        odd = turn % 2 == 1
        return F.struct(
            F.when(odd, to_left).otherwise(state["l"]).alias("l"), F.when(odd, state["r"]).otherwise(to_right).alias("r")
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _power(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10**k).cast("long") for k in range(16)]), n + 1)


def permuted_digits(digits: Column, key: str, tweak: Column) -> Column:
    """Two to thirty digits permuted among all strings of as many."""

    def run(d: Column) -> Column:
        u = F.floor(F.length(d) / 2).cast("int")
        v = F.length(d) - u
        mixed = feistel(
            F.substring(d, F.lit(1), u),
            F.substring(d, u + 1, v),
            _power(u),
            _power(v),
            key,
            F.concat_ws("/", tweak, F.length(d)),
        )
        return let(mixed, lambda m: F.concat(F.lpad(m["l"].cast("string"), u, "0"), F.lpad(m["r"].cast("string"), v, "0")))

    return let(digits, run)


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of Luhn's rule; digits are doubled whose place from the right (1 at first) leaves ``doubled`` by 2."""

    def worth(place: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when(place % 2 == doubled, twice).otherwise(digit)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x)


def _into_places(text: Column, digits: Column) -> Column:
    """``text`` with its digits, from the left, replaced by ``digits``."""

    def put(state: Column, char: Column) -> Column:
        is_digit = char.rlike("[0-9]")
        piece = F.when(is_digit, F.substring(digits, state["n"] + 1, F.lit(1))).otherwise(char)
        return F.struct(
            F.concat(state["out"], piece).alias("out"), (state["n"] + F.when(is_digit, 1).otherwise(0)).alias("n")
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))
    return F.aggregate(F.split(text, ""), start, put, lambda s: s["out"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _card(text: Column, key: str) -> Column:
    """A number that has passed Luhn's check."""

    def run(d: Column) -> Column:
        payload = permuted_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, F.lit("card"))
        check = lambda p: F.pmod(10 - luhn_sum(p, 1) % 10, F.lit(10)).cast("string")
        return let(payload, lambda p: _into_places(text, F.concat(p, check(p))))

    return let(_digits(text), run)


def _cards(groups: Column) -> Column:
    """The places ``(i, n)`` of cards in ``groups`` (each with the separator after it): neighbours of 13 to 19 digits
    that pass Luhn's check. Among other numbers only a single group, or a usual layout of a known issuer, is one; where
    such overlap, known issuers go first."""
    whole = F.size(groups)

    def at(i: Column, n: Column) -> Column:
        text = F.regexp_replace(F.array_join(F.slice(groups, i, n), ""), "[ -]$", "")
        return F.struct(i.alias("i"), n.alias("n"), text.alias("text"), _digits(text).alias("digits"))

    def from_group(i: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.least(F.lit(CARD_GROUPS), whole - i + 1)), lambda n: at(i, n))

    def ranked(c: Column) -> Column:
        usual, known = c["text"].rlike(_LAYOUT), c["digits"].rlike(_ISSUER)
        rank = F.when(usual & known, 0).when(c["n"] == 1, 1).when(c["n"] == whole, 2)
        return F.struct(rank.alias("rank"), c["i"].alias("i"), c["n"].alias("n"))

    def possible(c: Column) -> Column:
        return F.length(c["digits"]).between(13, 19) & ~c["text"].rlike("[ -]{2}")

    def free(taken: Column, c: Column) -> Column:
        meets = F.exists(taken, lambda t: (t["i"] < c["i"] + c["n"]) & (c["i"] < t["i"] + t["n"]))
        return F.when(meets, taken).otherwise(F.concat(taken, F.array(F.struct(c["i"].alias("i"), c["n"].alias("n")))))

    parts = F.flatten(F.transform(F.sequence(F.lit(1), whole), from_group))
    every = F.when(whole > CARD_GROUPS, F.concat(parts, F.array(at(F.lit(1), whole)))).otherwise(parts)
    valid = F.filter(F.filter(every, possible), lambda c: luhn_sum(c["digits"], 0) % 10 == 0)
    order = F.array_sort(F.filter(F.transform(valid, ranked), lambda c: c["rank"].isNotNull()))
    return F.array_sort(F.aggregate(order, F.array().cast("array<struct<i:int,n:int>>"), free))


def _phone(text: Column, key: str) -> Column:
    """The country code stays, the number after it is permuted; seven to fifteen digits in all. A number without a
    code is permuted like the same number after +1."""

    def run(code: Column) -> Column:
        rest = F.substring(text, F.length(code) + 1, F.length(text))
        country = F.when(code == "", "+1").otherwise(code)
        changed = F.concat(code, _into_places(rest, permuted_digits(_digits(rest), key, F.concat(F.lit("phone"), country))))
        return F.when(F.length(_digits(text)).between(7, 15), changed).otherwise(text)

    return let(F.regexp_extract(text, rf"^\+(?:[0-9]{{1,3}}(?=[ .(-])|{_CODE})", 0), run)


def _social(text: Column, key: str) -> Column:
    valid = ~text.rlike("^(000|666|9)|-00-|-0000$")
    return F.when(valid, _into_places(text, permuted_digits(_digits(text), key, F.lit("social")))).otherwise(text)


def _host(text: Column, key: str) -> Column:
    def run(p: Column) -> Column:
        part = lambda k: F.element_at(p, k).cast("int")
        mixed = feistel(
            part(1) * 256 + part(2), part(3) * 256 + part(4), F.lit(65536), F.lit(65536), key, F.lit("host")
        )
        halves = let(
            mixed,
            lambda m: F.concat_ws(
                ".",
                *[x.cast("string") for h in (m["l"], m["r"]) for x in (F.shiftright(h, 8), h.bitwiseAND(F.lit(255)))],
            ),
        )
        return F.when(F.forall(p, lambda x: x.cast("int") <= 255), halves).otherwise(text)

    return let(F.split(text, r"\."), run)


def _host6(text: Column, key: str) -> Column:
    """Eight groups of four digits, however the address is abbreviated. Each half is permuted with the other one as tweak,
    so the whole is a permutation too."""
    wide = F.lit(1 << 32)

    def groups(half: Column) -> Column:
        return F.filter(F.split(half, ":"), lambda g: g != "")

    def all_groups(halves: Column) -> Column:
        head, tail = groups(halves[0]), groups(F.coalesce(F.get(halves, F.lit(1)), F.lit("")))
        return F.concat(head, F.array_repeat(F.lit("0"), F.lit(8) - F.size(head) - F.size(tail)), tail)

    def words(g: Column) -> Column:
        number = lambda k: F.conv(F.element_at(g, k), 16, 10).cast("long")
        return F.array(*[F.shiftleft(number(k), 16) + number(k + 1) for k in (1, 3, 5, 7)])

    def permuted(w: Column) -> Column:
        first = feistel(w[0], w[1], wide, wide, key, F.concat_ws("/", F.lit("host6"), w[2], w[3]))
        second = lambda m: feistel(w[2], w[3], wide, wide, key, F.concat_ws("/", F.lit("host6"), m["l"], m["r"]))
        return let(first, lambda m: let(second(m), lambda n: F.array(m["l"], m["r"], n["l"], n["r"])))

    def written(w: Column) -> Column:
        digits = F.transform(w, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
        return F.array_join(
            F.transform(digits, lambda d: F.concat(F.substring(d, 1, 4), F.lit(":"), F.substring(d, 5, 4))), ":"
        )

    def run(g: Column) -> Column:
        valid = (F.size(g) == 8) & text.rlike("[0-9]")
        return F.when(valid, let(let(words(g), permuted), written)).otherwise(text)

    return let(let(F.split(text, "::"), all_groups), run)


def _left_of_97(text: Column) -> Column:
    """What 97 leaves of the number that ``text`` is, with letters as 10 to 35."""

    def step(rest: Column, char: Column) -> Column:
        worth = F.when(char.rlike("[0-9]"), F.ascii(char) - 48).otherwise(F.ascii(char) - 55)
        return (rest * F.when(worth < 10, 10).otherwise(100) + worth) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _iban(text: Column, key: str) -> Column:
    """An account that has passed the check by 97: its digits are permuted and the check digits follow. The country
    stays, as do letters, which name the bank."""

    def run(compact: Column) -> Column:
        country, check = F.substring(compact, 1, 2), F.substring(compact, 3, 2)
        account = F.substring(compact, F.lit(5), F.length(compact))
        digits = permuted_digits(_digits(account), key, F.concat(F.lit("iban/"), country))

        def checked(new: Column) -> Column:
            bare = F.concat(_into_places(account, new), country, F.lit("00"))
            return _into_places(text, F.concat(F.lpad((98 - _left_of_97(bare)).cast("string"), 2, "0"), new))

        passes = (_left_of_97(F.concat(account, country, check)) == 1) & check.between("02", "98")
        return F.when(passes & (F.length(_digits(account)) > 1), let(digits, checked)).otherwise(text)

    return let(F.replace(text, F.lit(" "), F.lit("")), run)


def _date(text: Column, key: str) -> Column:
    """Real days only, within their 400 years; the way the date is written stays."""
    a, b = DAY_PARTS

    def written(form: str) -> Column:
        def run(day: Column) -> Column:
            since = F.date_diff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
            cycle, at = F.floor(since / (a * b)), F.pmod(since, F.lit(a * b))
            tweak = F.when(cycle == 0, "date").otherwise(F.concat(F.lit("date/"), cycle.cast("string")))
            mixed = feistel(F.floor(at / b), at % b, F.lit(a).cast("long"), F.lit(b).cast("long"), key, tweak)
            to = lambda m: (cycle * (a * b) + m["l"] * b + m["r"]).cast("int")
            moved = let(mixed, lambda m: F.date_add(F.lit(FIRST_DAY).cast("date"), to(m)))
            known = day.between(F.lit(EARLIEST_DAY).cast("date"), F.lit(LATEST_DAY).cast("date"))
            return F.when(known, F.date_format(moved, form)).otherwise(text)

        return let(F.try_to_timestamp(text, F.lit(form)).cast("date"), run)

    return (
        F.when(text.contains("-"), written("yyyy-MM-dd"))
        .when(text.contains("."), written("dd.MM.yyyy"))
        .otherwise(written("MM/dd/yyyy"))
    )


def _mail(text: Column, key: str) -> Column:
    """A name that stands for the address without regard to case, at a domain that never exists."""
    return F.concat(F.lit("p"), F.substring(_keyed(key, F.lit("mail"), F.lower(text)), 1, 16), F.lit("@mail.invalid"))


def _secret(text: Column, key: str) -> Column:
    """As many hexadecimal digits in place of the value."""

    def run(head: Column) -> Column:
        quote = F.regexp_extract(text, "[\"']$", 0)
        value = F.substring(text, F.length(head) + 1, F.length(text) - F.length(head) - F.length(quote))
        whole = F.concat_ws("|", F.lit(key), F.lit("secret"), value)
        block = lambda k: F.sha2(F.when(k == 0, whole).otherwise(F.concat(whole, F.lit("|"), k.cast("string"))), 512)
        digits = F.array_join(F.transform(F.sequence(F.lit(0), F.floor(F.length(value) / 128)), block), "")
        return F.concat(head, F.substring(digits, F.lit(1), F.length(value)), quote)

    return let(F.regexp_extract(text, f"^{_SECRET_NAME}[\"']?", 0), run)


def kind_of(match: Column) -> Column:
    """Which of KINDS a match of PATTERN is."""
    return (
        F.when(match.rlike(f"^{_SECRET_NAME}"), "secret")
        .when(match.contains("@"), "mail")
        .when(match.contains(":"), "host6")
        .when(match.rlike("^[A-Z]{2}"), "iban")
        .when(match.rlike(r"^([0-9]{1,3}\.){3}[0-9]{1,3}$"), "host")
        .when(match.rlike(r"^[+(]|^[0-9]{3}-[0-9]{3}-[0-9]{4}$"), "phone")
        .when(match.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "social")
        .when(match.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})$"), "date")
        .otherwise("card")
    )


def pseudonym(match: Column, key: str) -> Column:
    """Struct of ``kind``, ``old`` and ``new`` for all kinds but cards; ``new`` is the match itself where it is no valid
    value of its kind."""
    forms = {
        "mail": _mail,
        "secret": _secret,
        "iban": _iban,
        "host6": _host6,
        "host": _host,
        "phone": _phone,
        "date": _date,
        "social": _social,
    }

    def run(kind: Column) -> Column:
        chosen = F.when(kind == KINDS[0], forms[KINDS[0]](match, key))
        for name in KINDS[1:-1]:
            chosen = chosen.when(kind == name, forms[name](match, key))
        return F.struct(kind.alias("kind"), match.alias("old"), chosen.alias("new"))

    return let(kind_of(match), run)


_TOKEN = "struct<kind:string,old:string,new:string>"


def _plain(text: Column) -> Column:
    return F.struct(F.lit(None).cast("string").alias("kind"), text.alias("old"), text.alias("new"))


def _run_tokens(run: Column, key: str) -> Column:
    """A run of numbers as tokens: its cards, and dates and social security numbers in what is left of it."""

    def rest(text: Column) -> Column:
        forms = {"date": _date, "social": _social}

        def known(m: Column) -> Column:
            kind = kind_of(m)
            chosen = F.coalesce(*[F.when(kind == k, form(m, key)) for k, form in forms.items()], m)
            return F.struct(kind.alias("kind"), m.alias("old"), chosen.alias("new"))

        between = F.split(text, _IN_RUN, -1)
        found = F.transform(F.regexp_extract_all(text, F.lit(_IN_RUN), F.lit(0)), known)
        pairs = F.zip_with(between, found, lambda piece, f: F.array(_plain(piece), f.cast(_TOKEN)))
        return F.filter(F.flatten(pairs), lambda t: t.isNotNull())

    def pieces(groups: Column) -> Column:
        start = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<card:boolean,text:string>>").alias("out"))
        of = lambda i, n: F.array_join(F.slice(groups, i, n), "")
        piece = lambda card, text: F.struct(F.lit(card).alias("card"), text.alias("text"))

        def step(state: Column, c: Column) -> Column:
            before = piece(False, of(state["next"], c["i"] - state["next"]))
            here = piece(True, of(c["i"], c["n"]))
            return F.struct((c["i"] + c["n"]).alias("next"), F.concat(state["out"], F.array(before, here)).alias("out"))

        last = lambda s: F.concat(s["out"], F.array(piece(False, of(s["next"], F.size(groups) - s["next"] + 1))))
        return F.aggregate(_cards(groups), start, step, last)

    def tokens(p: Column) -> Column:
        number = F.regexp_replace(p["text"], "[ -]$", "")
        card = F.struct(F.lit("card").alias("kind"), number.alias("old"), _card(number, key).alias("new"))
        after = _plain(F.regexp_extract(p["text"], "[ -]?$", 0))
        return F.when(p["card"], F.array(card.cast(_TOKEN), after)).otherwise(rest(p["text"]))

    return F.flatten(F.transform(let(F.split(run, "(?<=[ -])", -1), pieces), tokens))


def pseudonymize(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with personal data replaced in ``text``, and ``found``, an array of ``(kind, old, new)`` in text order.

    A null text stays null and an empty one empty, with nothing found; every row, repeated or not, is treated by
    itself, so there is no shuffle. Numbers and dates that fail their check stay as they are. Columns other than
    ``text`` are not touched (an equally named ``found`` is replaced); an empty table gives no rows.
    """
    hit = F.col("text").rlike(HINT)

    def tokens(m: Column) -> Column:
        return F.when(kind_of(m) == "card", _run_tokens(m, key)).otherwise(F.array(pseudonym(m, key).cast(_TOKEN)))

    matches = F.transform(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)), tokens)
    found = docs.withColumn("found", F.when(hit, matches).otherwise(F.array().cast(f"array<array<{_TOKEN}>>")))
    between = F.split("text", PATTERN, -1)
    new = lambda f: F.array_join(F.transform(f, lambda t: t["new"]), "")
    joined = F.zip_with(between, "found", lambda piece, f: F.concat(piece, F.coalesce(new(f), F.lit(""))))
    text = F.when(F.size("found") > 0, F.array_join(joined, "")).otherwise(F.col("text"))
    values = F.filter(F.flatten("found"), lambda t: t["kind"].isNotNull())
    return found.withColumns({"text": text, "found": values})


def _of_kind(kind: str) -> Callable[[Column], Column]:
    return lambda f: f["kind"] == kind


def report(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``(doc_id, text, n_replaced, n_mail, ...)``: the text after replacement, how many values were replaced, by kind."""
    changed = pseudonymize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), key)
    replaced = F.filter("found", lambda f: f["new"] != f["old"])
    return changed.withColumn("found", replaced).select(
        "doc_id",
        "text",
        F.size("found").cast("long").alias("n_replaced"),
        *[F.size(F.filter("found", _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS],
    )


def without_personal_data(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with text pseudonymized; ``n_chars``, where present, follows the new text."""
    changed = pseudonymize(docs, key).drop("found")
    if "n_chars" not in changed.columns:
        return changed
    return changed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
