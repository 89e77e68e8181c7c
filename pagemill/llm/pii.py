"""Pseudonyms for personal data, in its own format, by keyed permutations.

Numbers and dates that are valid (card numbers by check digit, account numbers
by remainder, addresses by range, telephone and social security numbers by
their ranges, dates by the calendar) are permuted by a Feistel network over just
the values of their format: the pseudonym is valid too, the same value gets the
same pseudonym in every document, and different values never share one. The
domain is a product a * b; each round adds a keyed function of one half to the other,
modulo its size, so no value leaves the domain. E-mail addresses and secrets,
which are no numbers, get keyed digests in their form.

Left out: telephone numbers without a plus, other than three, three and four digits
with separators; a trunk zero in brackets, as in +44 (0)20; extensions; dates with the
name of the month, with two digits of the year, of the form dd-MM-yyyy or yyyyMMdd, or before 1900
or after 2099. A plus before 8 to 15 digits is taken for a telephone number, also where
it is the sign of a number, and takes in groups of digits that follow, up to 15 in all.

Everything is a column expression: a pattern cuts the text into what lies
between matches and the matches, which are replaced and put back.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm import store

ROUNDS = 8

EMAIL = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9](?:[A-Za-z0-9.-]{0,252}[A-Za-z0-9])?"
    r"\.[A-Za-z]{2,}+"
)
SECRET = (
    r"(?i:(?<![A-Za-z])(?:password|passwd|pwd|secret|token|api[_-]?key)\s?[=:]\s?[\"']?)"
    r"[^\s\"']{6,}+"
)
ACCESS_KEY = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"
SSN = r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"
DATE = (
    r"(?<![\w./-])(?:[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}|"
    r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?:(?=T[0-9])|(?![\w/-]))"
)
ADDRESS = r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\w|\.[0-9])"
PHONE = (
    r"(?<![\w(])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
    r"(?!\w)"
)
FOREIGN_PHONE = r"(?<![\w+])\+[0-9](?:[ .-]?[0-9]){7,14}(?!\w)"
COUNTRY_CODE = (
    "^[+](?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
)
# account and card numbers: the whole run of groups is one match, in which _numbers() looks for
# those that are valid; it ends before a group at which a stricter form begins
STRICT = "|".join([EMAIL, SECRET, ACCESS_KEY, SSN, DATE, ADDRESS, PHONE])
IBAN = (
    r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11})[A-Z0-9]++(?![a-z])"
    rf"(?:(?![ ](?:{STRICT}))[ -][A-Z0-9]++(?![a-z]))*+"
)
CARD = (
    r"(?<![\w-])(?=(?:[0-9][ -]?){12}[0-9])[0-9]++(?!\w|-(?![0-9]))"
    rf"(?:(?![ ](?:{STRICT}))[ -][0-9]++(?!\w|-(?![0-9])))*+"
)
# usual layouts of card numbers; others count where none of these is valid
CARD_LAYOUT = (
    r"^(?:[0-9]+|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})$"
)
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
MOST_GROUPS = 34  # of one number

# in this order: a longer or stricter form before one that could match a part of it
PATTERN = "|".join([EMAIL, SECRET, ACCESS_KEY, IBAN, SSN, DATE, ADDRESS, PHONE, FOREIGN_PHONE, CARD])
HINT = r"[0-9@]|AKIA|ASIA|(?i:pass|pwd|secret|token|key)"  # no text without these has a match


def _digest(key: Column | str, *parts: Column | str) -> Column:
    each = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in (key, *parts)]
    return F.sha2(F.concat_ws("|", *each), 256)


def _number(hexadecimal: Column) -> Column:
    """60 bits of a digest."""
    return F.conv(F.substring(hexadecimal, 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, kind: str, key: Column | str) -> Column:
    """Permutes pairs (left in [0, a), right in [0, b)); a struct of both."""

    def turn(s: Column, i: Column) -> Column:
        into_left = F.pmod(s.l + F.pmod(_number(_digest(key, kind, i, s.r)), a), a)
        into_right = F.pmod(s.r + F.pmod(_number(_digest(key, kind, i, s.l)), b), b)
        odd = i % 2 == 1
        return F.struct(
            F.when(odd, into_left).otherwise(s.l).alias("l"),
            F.when(odd, s.r).otherwise(into_right).alias("r"),
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _let(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _permuted_digits(d: Column, kind: str, key: Column | str) -> Column:
    """A string of 2 to 36 digits, permuted among those of its length."""
    n = F.length(d)
    u = F.floor(n / 2).cast("int")
    size = lambda k: F.rpad(F.lit("1"), k + 1, "0").cast("long")
    out = feistel(
        d.substr(F.lit(1), u).cast("long"),
        d.substr(u + 1, n - u).cast("long"),
        size(u),
        size(n - u),
        f"{kind}",
        key,
    )
    return _let(
        out, lambda s: F.concat(F.lpad(s.l.cast("string"), u, "0"), F.lpad(s.r.cast("string"), n - u, "0"))
    )


def _refilled(m: Column, digits: Column) -> Column:
    """m with its digits, in order, replaced by those of `digits`."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def step(s: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        return F.struct(
            F.concat(s.out, F.when(is_digit, digits.substr(s.k, F.lit(1))).otherwise(c)).alias("out"),
            F.when(is_digit, s.k + 1).otherwise(s.k).alias("k"),
        )

    return F.aggregate(F.split(m, ""), start, step, lambda s: s.out)


def _luhn_sum(digits: Column) -> Column:
    """Sum of the digits from the right, every second one, from the second on, doubled."""
    values = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(
            c.cast("int")
        ),
    )
    return F.aggregate(values, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))


def _card(m: Column, key: Column | str) -> Column:
    def permuted(d: Column) -> Column:
        body = _permuted_digits(d.substr(F.lit(1), F.length(d) - 1), "card", key)
        return _let(
            body,
            lambda p: F.concat(
                p, ((F.lit(10) - _luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string")
            ),
        )

    return _refilled(m, _let(_digits(m), permuted))


def _is_card(m: Column) -> Column:
    d = _digits(m)
    return (
        m.rlike("^[0-9 -]+$")
        & F.length(d).between(13, 19)
        & ~d.rlike("^0+$")
        & (_luhn_sum(d) % 10 == 0)
    )


def _remainder(text: Column) -> Column:
    """Of letters (A = 10) and digits as a number, modulo 97."""

    def step(s: Column, c: Column) -> Column:
        letter = c.rlike("[A-Z]")
        return F.when(letter, (s * 100 + F.ascii(c) - 55) % 97).otherwise(
            (s * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97
        ).cast("int")

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _iban(m: Column, key: Column | str) -> Column:
    plain = F.regexp_replace(m, " ", "")
    country, body = plain.substr(1, 2), F.substring(plain, 5, 64)

    def permuted(d: Column) -> Column:
        # the digits of the body; letters stay
        inner = F.when(F.length(d) > 1, _permuted_digits(d, "iban", key)).otherwise(d)
        filled = _let(inner, lambda p: _refilled(body, p))
        return _let(
            filled,
            lambda x: F.concat(
                F.lpad((F.lit(98) - _remainder(F.concat(x, country, F.lit("00")))).cast("string"), 2, "0"),
                _digits(x),
            ),
        )

    return _refilled(m, _let(_digits(body), permuted))


def _is_iban(m: Column) -> Column:
    """Of its country's length, if the country is known, and with the right remainder."""
    plain = F.regexp_replace(m, " ", "")
    country = plain.substr(1, 2)
    known = F.lit(None).cast("int")
    for n, countries in IBAN_LENGTHS.items():
        known = F.when(country.isin(countries.split()), n).otherwise(known)
    return (
        m.rlike("^[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}$")
        & (F.length(plain) == F.coalesce(known, F.length(plain)))
        & (_remainder(F.concat(F.substring(plain, 5, 64), plain.substr(1, 4))) == 1)
    )


def _numbers(m: Column, key: Column | str) -> Column:
    """A run of groups with its valid account and card numbers replaced, from the left.

    Of those that begin with one group, the usual layouts come first, then the longest. A card
    number of another layout gives way to a usual one that begins inside it.
    """

    def piece(groups: Column, i: Column, n: Column) -> Column:
        return F.regexp_replace(F.array_join(F.slice(groups, i, n), ""), "[ -]$", "")

    def rank(p: Column) -> Column:
        usual = F.when(p.rlike(CARD_LAYOUT), 2).otherwise(1)
        return F.when(_is_iban(p), 2).when(_is_card(p), usual).otherwise(0)

    def best(groups: Column, i: Column) -> Column:
        most = F.least(F.lit(MOST_GROUPS), F.size(groups) - i + 1)
        return F.array_max(
            F.transform(
                F.sequence(F.lit(1), most),
                lambda n: F.struct(_let(piece(groups, i, n), rank).alias("rank"), n.alias("n")),
            )
        )

    def joined(groups: Column, bests: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            b = F.element_at(bests, i)
            inside = F.exists(F.slice(bests, i + 1, b.n - 1), lambda x: x["rank"] == 2)
            take = (b["rank"] == 2) | ((b["rank"] == 1) & ~inside)
            after = F.regexp_extract(F.element_at(groups, i + b.n - 1), "[ -]$", 0)
            name = _let(
                piece(groups, i, b.n),
                lambda p: F.when(p.rlike("^[A-Z]"), _iban(p, key)).otherwise(_card(p, key)),
            )
            return F.when(i < s.next, s).otherwise(
                F.when(
                    take,
                    F.struct(
                        F.array_append(s.out, F.concat(name, after)).alias("out"),
                        (i + b.n).alias("next"),
                    ),
                ).otherwise(
                    F.struct(
                        F.array_append(s.out, F.element_at(groups, i)).alias("out"),
                        (i + 1).alias("next"),
                    )
                )
            )

        start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(1).alias("next"))
        return F.aggregate(
            F.sequence(F.lit(1), F.size(groups)), start, step, lambda s: F.array_join(s.out, "")
        )

    return _let(
        F.regexp_extract_all(m, F.lit("[^ -]++[ -]?"), F.lit(0)),
        lambda groups: _let(
            F.transform(F.sequence(F.lit(1), F.size(groups)), lambda i: best(groups, i)),
            lambda bests: joined(groups, bests),
        ),
    )


def _part(m: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(m, pattern, group).try_cast("long")


def _address(m: Column, key: Column | str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    get = lambda i: F.element_at(octets, i)
    size = F.lit(65536)
    out = feistel(get(1) * 256 + get(2), get(3) * 256 + get(4), size, size, "address", key)
    text = _let(
        out,
        lambda s: F.concat_ws(
            ".",
            *[F.floor(x / 256).cast("string") if high else (x % 256).cast("string")
              for x in (s.l, s.r) for high in (True, False)],
        ),
    )
    return F.when(F.forall(octets, lambda x: x <= 255), text).otherwise(m)


def _ssn(m: Column, key: Column | str) -> Column:
    shape = "^([0-9]{3})-([0-9]{2})-([0-9]{4})$"
    area, group, serial = (_part(m, shape, i) for i in (1, 2, 3))
    fine = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    out = feistel(
        area - 1 - F.when(area > 666, 1).otherwise(0),
        (group - 1) * 9999 + serial - 1,
        F.lit(898),
        F.lit(99 * 9999),
        "ssn",
        key,
    )
    text = _let(
        out,
        lambda s: F.format_string(
            "%03d-%02d-%04d",
            s.l + 1 + F.when(s.l >= 665, 1).otherwise(0),
            F.floor(s.r / 9999) + 1,
            s.r % 9999 + 1,
        ),
    )
    return F.when(fine, text).otherwise(m)


def _phone(m: Column, key: Column | str) -> Column:
    d = _digits(m)
    local = F.right(d, F.lit(10))
    prefix = d.substr(F.lit(1), F.length(d) - 10)
    shape = "^([0-9]{3})([0-9]{3})([0-9]{4})$"
    area, exchange, line = (_part(local, shape, i) for i in (1, 2, 3))
    size = F.lit(80_000)
    out = feistel(
        (area - 200) * 100 + F.floor(line / 100),
        (exchange - 200) * 100 + line % 100,
        size,
        size,
        "phone",
        key,
    )
    valid = _let(
        out,
        lambda s: F.format_string(
            "%03d%03d%02d%02d",
            F.floor(s.l / 100) + 200,
            F.floor(s.r / 100) + 200,
            s.l % 100,
            s.r % 100,
        ),
    )
    # numbers outside the plan's ranges are permuted as ten digits
    other = _permuted_digits(local, "other phone", key)
    fine = (area >= 200) & (exchange >= 200)
    return _refilled(m, F.concat(prefix, F.when(fine, valid).otherwise(other)))


def _foreign_phone(m: Column, key: Column | str) -> Column:
    """The digits after the country's code are permuted among numbers of their length."""
    digits = F.concat(F.lit("+"), _digits(m))
    code = F.regexp_extract(digits, COUNTRY_CODE, 0)
    rest = F.substring(digits, F.length(code) + 1, F.length(digits))
    moved = _permuted_digits(rest, "foreign phone", key)
    fine = F.length(_digits(m)).between(8, 15) & (code != "")
    return F.when(fine, _refilled(m, F.concat(F.substring(code, 2, 3), moved))).otherwise(m)


def _any_phone(m: Column, key: Column | str) -> Column:
    """Numbers of the North American plan are the same with and without +1 and separators."""
    foreign = m.startswith("+") & ~(m.startswith("+1") & (F.length(_digits(m)) == 11))
    return F.when(foreign, _foreign_phone(m, key)).otherwise(_phone(m, key))


# days from 1900-01-01 to 2099-12-31: 73049 = 319 * 229
_FIRST_DAY, _LAST_DAY, _DAYS_A, _DAYS_B = "1900-01-01", "2099-12-31", 319, 229


def _date(m: Column, key: Column | str) -> Column:
    """The day is permuted, whatever its layout, so the same day is the same in each."""
    layouts = [
        ("^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"),
        ("^[0-9]{4}-", "yyyy-M-d"),
        ("^[0-9]{4}/[0-9]{2}/[0-9]{2}$", "yyyy/MM/dd"),
        ("^[0-9]{4}/", "yyyy/M/d"),
        ("^[0-9]{2}[.][0-9]{2}[.]", "dd.MM.yyyy"),
        ("^[0-9]{1,2}[.]", "d.M.yyyy"),
        ("^[0-9]{2}/[0-9]{2}/", "MM/dd/yyyy"),
        ("^[0-9]{2}/[0-9]{2}/", "dd/MM/yyyy"),
        ("^[0-9]{1,2}/", "M/d/yyyy"),
        ("^[0-9]{1,2}/", "d/M/yyyy"),
    ]
    first = F.lit(_FIRST_DAY).cast("date")

    def read(shape: str, layout: str) -> Column:
        day = F.when(m.rlike(shape), F.try_to_timestamp(m, F.lit(layout)).cast("date"))
        fine = day.between(first, F.lit(_LAST_DAY).cast("date"))
        return F.when(fine, F.struct(F.datediff(day, first).alias("n"), F.lit(layout).alias("layout")))

    def moved(found: Column) -> Column:
        pair = feistel(
            F.floor(found.n / _DAYS_B), found.n % _DAYS_B, F.lit(_DAYS_A), F.lit(_DAYS_B), "date", key
        )
        return _let(
            pair,
            lambda s: F.call_function(
                "date_format", F.date_add(first, (s.l * _DAYS_B + s.r).cast("int")), found.layout
            ),
        )

    found = F.coalesce(*[read(*x) for x in layouts])
    return _let(found, lambda f: F.when(f.isNull(), m).otherwise(moved(f)))


def _email(m: Column, key: Column | str) -> Column:
    address = F.lower(m)
    domain = F.substring_index(address, "@", -1)
    return F.concat(
        F.lit("u"),
        F.substring(_digest(key, "email", address), 1, 12),
        F.lit("@d"),
        F.substring(_digest(key, "domain", domain), 1, 8),
        F.lit(".example"),
    )


def _secret(m: Column, key: Column | str) -> Column:
    shape = "(?s)^([A-Za-z_-]+\\s?[=:]\\s?[\"']?)(.*)$"
    digest = _digest(key, "secret", F.regexp_extract(m, shape, 2))
    return F.concat(F.regexp_extract(m, shape, 1), F.lit("x"), F.substring(digest, 1, 15))


def _access_key(m: Column, key: Column | str) -> Column:
    digest = F.upper(F.substring(_digest(key, "access key", m), 1, 16))
    return F.concat(F.lit("PSEU"), digest)


def pseudonym(m: Column, key: Column | str) -> Column:
    """The pseudonym of one match of PATTERN; a match that is not valid stays as it is.

    Of a run of groups, the valid account and card numbers in it are replaced and the others stay.
    """
    form = lambda pattern: m.rlike(f"^(?:{pattern})$")
    return (
        F.when(m.contains("@") & form(EMAIL), _email(m, key))
        .when(form(SECRET), _secret(m, key))
        .when(form(ACCESS_KEY), _access_key(m, key))
        .when(form(SSN), _ssn(m, key))
        .when(form(DATE), _date(m, key))
        .when(form(ADDRESS), _address(m, key))
        .when(form(PHONE) | form(FOREIGN_PHONE), _any_phone(m, key))
        .otherwise(_numbers(m, key))
    )


def pseudonymised(documents: DataFrame, key: str, count: str | None = None) -> DataFrame:
    """All columns; in `text`, personal data replaced by pseudonyms.

    Whoever has the key can undo the permutations. Plans do not show it.
    A null text stays null, an empty one empty; texts are treated whole, row by
    row, without a shuffle, so repeated rows get the same result. `n_chars`, where it
    is a column, is counted anew if the text changed. `count` names a column for the number of values replaced.
    """
    text = F.col("text")
    found, between, names, secret = (
        store.free_name(documents, n) for n in ("pii_found", "pii_between", "pii_names", "pii_key")
    )
    # a row of its own, not a literal: those are part of plans and logs
    keys = documents.sparkSession.createDataFrame(pa.table({"k": [key]}))
    hinted = F.coalesce(text.rlike(HINT), F.lit(False))
    none = F.array().cast("array<string>")
    cut = documents.select(
        "*",
        F.when(hinted, F.regexp_extract_all("text", F.lit(PATTERN), 0)).otherwise(none).alias(
            found
        ),
        keys.scalar().alias(secret),
    ).select(
        "*",
        F.when(F.size(found) > 0, F.split("text", PATTERN, -1)).alias(between),
        F.transform(found, lambda m: pseudonym(m, F.col(secret))).alias(names),
    )
    joined = F.concat(
        F.element_at(between, 1),
        F.array_join(
            F.zip_with(
                names,
                F.slice(between, F.lit(2), F.size(found)),
                lambda name, after: F.concat(name, after),
            ),
            "",
        ),
    )
    new = F.when(F.size(found) > 0, joined).otherwise(text)
    changed = F.size(F.filter(F.arrays_zip(found, names),
                              lambda x: x[found] != x[names]))
    out = []
    for c in documents.columns:
        if c == "text":
            out.append(new.alias("text"))
        elif c == "n_chars":
            kind = documents.schema["n_chars"].dataType
            out.append(
                F.when(changed > 0, F.char_length(new).cast(kind)).otherwise(F.col(c)).alias(c)
            )
        else:
            out.append(F.col(f"`{c}`"))
    if count:
        out.append(changed.cast("long").alias(count))
    return cut.select(*out)
