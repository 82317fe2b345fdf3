"""Personal numbers, dates and addresses replaced by pseudonyms of the same format.

Numbers and dates that pass their format's checks are permuted within the format by a keyed Feistel network,
so that a pseudonym is valid too, equal values get equal pseudonyms in all documents, and different values
different ones. A network works on a domain of left * right values: the halves take turns in being shifted,
modulo their size, by a keyed digest of the other. Every shift can be undone, so it is a permutation for
any two sizes.

  card    13 to 19 digits with a right check digit, unbroken or in groups; the check digit is made anew
  phone   North American numbers with country code or separators; area and exchange from 200 to 999
  ip      four numbers up to 255
  ssn     three, two and four digits with dashes, without the area, group and serial numbers never given out
  date    yyyy-mm-dd, dd.mm.yyyy, mm/dd/yyyy that exist, from 1800 to 2199, permuted as days; the three
          ways of writing a date have one pseudonym

Separators stay as they are. Groups of digits that stand side by side can be a card and its code, several cards,
or no card: a run of groups ends where another value begins, a group of 13 digits or more is judged by itself, and
within a run cards are looked for at every group, in the usual groupings first, then in groups of four digits
or more, and last over the whole run. What follows password= or token = " is a secret, whatever it looks like. E-mail addresses, access keys and the values of passwords and tokens have no
such format: their letters and digits are replaced by others from a keyed digest, length for length.

Only column expressions are used. Texts are cut at the matches of one pattern, and put together again with
the pseudonyms. Null stays null, and a text without matches stays as it is. Documents are handled row by row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmart.llm.arrow import unused

ROUNDS = 10
KEY = "example key"
KINDS = ("email", "secret", "ip", "phone", "card", "ssn", "date")

#: The patterns of each kind.
_VALUES = r"(?<=password=)[^\s\"']{6,}+|(?<=token = \")[0-9A-Za-z]{16,}+(?=\")"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+\-]{1,64}@(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "secret": rf"{_VALUES}|AKIA[0-9A-Z]{{16}}",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "phone": r"(?<![\d+])(?:\+?1[ .\-]?)?(?:\([2-9]\d\d\) ?|[2-9]\d\d[ .\-])[2-9]\d\d[ .\-]\d{4}(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "date": r"(?<!\d)(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?!\d)",
}
#: From one group of digits to the next, unless another value or a group that is judged by itself begins there.
_NEXT = rf"[ \-](?!{'|'.join(PATTERNS[k] for k in ('email', 'ip', 'phone', 'ssn', 'date'))}|\d{{13}})"
PATTERNS["card"] = (
    r"(?<!\d)\d{13,19}(?!\d)"
    rf"|(?<!\d)(?=(?:\d(?:{_NEXT}(?=\d))?){{13}})\d{{1,12}}+(?!\d)(?:{_NEXT}\d{{1,12}}+(?!\d))*+"
)
_OTHERS = "|".join([PATTERNS["email"], *[PATTERNS[k] for k in ("secret", "ip", "phone", "ssn", "date", "card")]])
ANY = f"{_VALUES}|{_OTHERS}"
#: The same with the values after password= and token = in a group.
_MARKED = f"({_VALUES})|{_OTHERS}"
#: The usual groupings of a card, the most groups that are tried elsewhere, and numbers of digits, the likeliest first.
_GROUPINGS = ("4-4-4-4", "4-6-5", "4-6-4", "4-4-4-4-3")
_GROUPS = 5
_LENGTHS = (16, 15, 19, 14, 13, 18, 17)
_DIGITS, _LETTERS = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: Days from 1800-01-01 to 2199-12-31, and their split.
_DAYS = (27, 5411)


def _digest(key: str, *parts: Column) -> Column:
    """A keyed number of 60 bits."""
    text = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts], F.lit(key))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value.cast("bigint"), F.lit(by).cast("bigint"))


def feistel(value: Column, left: int, right: int, kind: str, key: str = KEY, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of the whole numbers below left * right."""
    start = F.struct(_div(value, right).alias("l"), F.pmod(value, F.lit(right).cast("bigint")).alias("r"))

    def turn(s: Column, i: Column) -> Column:
        to_left = (s["l"] + _digest(key, F.lit(kind), i, s["r"])) % F.lit(left)
        to_right = (s["r"] + _digest(key, F.lit(kind), i, s["l"])) % F.lit(right)
        even = i % 2 == 0
        return F.struct(F.when(even, to_left).otherwise(s["l"]).cast("bigint").alias("l"), F.when(even, s["r"]).otherwise(to_right).cast("bigint").alias("r"))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, turn)
    return done["l"] * F.lit(right) + done["r"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def _refill(shape: Column, chars: Column, pattern: str) -> Column:
    """`shape` with the characters that the pattern matches replaced by those of `chars`, in turn."""

    def put(s: Column, c: Column) -> Column:
        own = c.rlike(pattern)
        return F.struct(
            F.concat(s["out"], F.when(own, F.substr(chars, s["at"], F.lit(1))).otherwise(c)).alias("out"),
            (s["at"] + F.when(own, 1).otherwise(0)).alias("at"),
        )

    return F.aggregate(F.split(shape, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), put)["out"]


def luhn_sum(digits: Column) -> Column:
    """The sum of a number's digits, every second from the right doubled; a right number's is divisible by ten."""
    places = F.reverse(F.split(digits, ""))
    return F.aggregate(
        F.transform(places, lambda c, i: (c.cast("int") * (1 + i % 2))), F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)
    )


def _card(m: Column, key: str) -> Column:
    digits = _digits(m)
    head = F.substr(digits, F.lit(1), F.char_length(digits) - 1)
    out = F.lit(None).cast("string")
    for n in range(12, 19):
        half = n // 2
        new = F.lpad(feistel(head.cast("bigint"), 10 ** (n - half), 10**half, f"card{n}", key).cast("string"), n, "0")
        out = F.when(F.char_length(head) == n, new).otherwise(out)
    check = F.pmod(10 - luhn_sum(F.concat(out, F.lit("0"))) % 10, F.lit(10)).cast("string")
    return _refill(m, F.concat(out, check), "[0-9]")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _is_card(digits: Column) -> Column:
    return F.when(F.char_length(digits).between(13, 19), luhn_sum(digits) % 10 == 0).otherwise(F.lit(False))


def _joined(pieces: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(pieces, start, n), "")


def _card_options(pieces: Column, i: Column) -> Column:
    """The cards that begin with group i, as (rank, n groups, usual), the likeliest first."""

    def option(n: Column) -> Column:
        groups = F.transform(F.slice(pieces, i, n), lambda p: F.char_length(_digits(p)))
        usual = (n == 1) | F.array_join(groups.cast("array<string>"), "-").isin(*_GROUPINGS)
        fits = usual | F.forall(F.slice(groups, F.lit(1), n - 1), lambda x: x >= 4)

        def judged(digits: Column) -> Column:
            place = F.array_position(F.array(*[F.lit(x) for x in _LENGTHS]), F.char_length(digits)).cast("int")
            rank = place + F.when(usual, 0).otherwise(len(_LENGTHS))
            return F.when((i + n - 1 <= F.size(pieces)) & _is_card(digits) & fits, F.struct(rank.alias("rank"), n.alias("n"), usual.alias("usual")))

        return _let(_digits(_joined(pieces, i, n)), judged)

    return F.array_sort(F.filter(F.transform(F.sequence(F.lit(1), F.lit(_GROUPS)), option), lambda o: o.isNotNull()))


def _card_places(pieces: Column, options: Column) -> Column:
    """(free, picks): the cards of a run as (first group, groups, first group since the card before), and the first group after them."""
    start = F.struct(F.lit(1).alias("free"), F.array().cast("array<struct<i:int,n:int,since:int>>").alias("picks"))

    def step(s: Column, i: Column) -> Column:
        # an unusual grouping doesn't draw in groups where a card in a usual one begins
        def clear(o: Column) -> Column:
            return o["usual"] | ~F.exists(F.slice(options, i + 1, o["n"] - 1), lambda x: F.exists(x, lambda y: y["usual"]))

        def put(best: Column) -> Column:
            pick = F.struct(i.alias("i"), best["n"].alias("n"), s["free"].alias("since"))
            return F.when(best.isNull(), s).otherwise(F.struct((i + best["n"]).alias("free"), F.concat(s["picks"], F.array(pick)).alias("picks")))

        return F.when(i < s["free"], s).otherwise(_let(F.get(F.filter(F.element_at(options, i), clear), F.lit(0)), put))

    n = F.size(pieces)
    whole = F.struct((n + 1).alias("free"), F.array(F.struct(F.lit(1).alias("i"), n.alias("n"), F.lit(1).alias("since"))).alias("picks"))
    found = F.aggregate(F.sequence(F.lit(1), n), start, step)
    return _let(found, lambda s: F.when((F.size(s["picks"]) == 0) & _is_card(_digits(F.array_join(pieces, ""))), whole).otherwise(s))


def _cards(m: Column, key: str) -> Column:
    """(kinds, text) for a run of groups of digits."""

    def rebuilt(pieces: Column, s: Column) -> Column:
        def put(p: Column) -> Column:
            return F.concat(_joined(pieces, p["since"], p["i"] - p["since"]), _let(_joined(pieces, p["i"], p["n"]), lambda c: _card(c, key)))

        rest = _joined(pieces, s["free"], F.size(pieces) - s["free"] + 1)
        text = F.concat(F.array_join(F.transform(s["picks"], put), ""), rest)
        return F.struct(F.transform(s["picks"], lambda p: F.lit("card")).alias("kinds"), text.alias("text"))

    def parsed(pieces: Column) -> Column:
        options = F.transform(F.sequence(F.lit(1), F.size(pieces)), lambda i: _card_options(pieces, i))
        return _let(_let(options, lambda o: _card_places(pieces, o)), lambda s: rebuilt(pieces, s))

    return _let(F.regexp_extract_all(m, F.lit(r"[0-9]+[ \-]?"), F.lit(0)), parsed)


def _phone(m: Column, key: str) -> tuple[Column, Column]:
    digits = F.right(_digits(m), F.lit(10))
    area, exchange, line = (F.substr(digits, F.lit(a), F.lit(n)).cast("bigint") for a, n in ((1, 3), (4, 3), (7, 4)))
    new = feistel(((area - 200) * 800 + (exchange - 200)) * 10_000 + line, 80_000, 80_000, "phone", key)
    parts = [F.lpad(x.cast("string"), n, "0") for x, n in ((_div(new, 8_000_000) + 200, 3), (_div(new, 10_000) % 800 + 200, 3), (new % 10_000, 4))]
    code = F.when(F.char_length(_digits(m)) > 10, F.lit("1")).otherwise(F.lit(""))
    return F.lit(True), _refill(m, F.concat(code, *parts), "[0-9]")


def _ip(m: Column, key: str) -> tuple[Column, Column]:
    part = F.split(m, r"\.")
    value = F.aggregate(part, F.lit(0).cast("bigint"), lambda a, x: a * 256 + x.cast("bigint"))
    new = feistel(value, 65_536, 65_536, "ip", key)
    return F.lit(True), F.concat_ws(".", *[(_div(new, 256**k) % 256).cast("string") for k in (3, 2, 1, 0)])


def _ssn(m: Column, key: str) -> tuple[Column, Column]:
    area, group, serial = (F.substr(m, F.lit(a), F.lit(n)).cast("bigint") for a, n in ((1, 3), (5, 2), (8, 4)))
    good = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    place = area - 1 - (area > 666).cast("int")
    new = feistel((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, "ssn", key)
    first = _div(new, 9999)
    place = _div(first, 99)
    parts = (place + 1 + (place >= 665).cast("int"), 3), (first % 99 + 1, 2), (new % 9999 + 1, 4)
    return good, F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in parts])


def _date(m: Column, key: str) -> tuple[Column, Column]:
    out, good = F.lit(None).cast("string"), F.lit(False)
    for mark, pattern in (("-", "yyyy-MM-dd"), (".", "dd.MM.yyyy"), ("/", "MM/dd/yyyy")):
        day = F.try_to_date(m, pattern)
        mine = m.contains(mark) & day.isNotNull() & F.year(day).between(1800, 2199)
        new = feistel(F.datediff(day, F.lit("1800-01-01").cast("date")).cast("bigint"), *_DAYS, "date", key)
        out = F.when(mine, F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), new.cast("int")), pattern)).otherwise(out)
        good = good | mine
    return F.coalesce(good, F.lit(False)), out


def _scrambled(m: Column, kind: str, key: str) -> Column:
    """Letters and digits replaced by those of a keyed digest: small letters, capitals and digits stay such.

    A digest serves 32 characters; the next ones are made of the first, so the value is digested once.
    """

    def put(c: Column, x: Column) -> Column:
        letter = F.substr(F.lit(_LETTERS), x % 26 + 1, F.lit(1))
        digit = F.substr(F.lit(_DIGITS), x % 10 + 1, F.lit(1))
        small, large = c.rlike("[a-z]"), c.rlike("[A-Z]")
        return F.when(small, letter).when(large, F.upper(letter)).when(c.rlike("[0-9]"), digit).otherwise(c)

    def replaced(digests: Column) -> Column:
        def draw(c: Column, i: Column) -> Column:
            return put(c, F.conv(F.substr(F.get(digests, F.shiftright(i, 5)), 2 * (i % 32) + 1, F.lit(2)), 16, 10).cast("int"))

        return F.array_join(F.transform(F.split(m, ""), draw), "")

    def blocks(first: Column) -> Column:
        more = F.sequence(F.lit(0), F.shiftright(F.char_length(m), 5))
        return F.transform(more, lambda k: F.when(k == 0, first).otherwise(F.sha2(F.concat_ws("|", first, k.cast("string")), 256)))

    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.lower(m) if kind == "email" else m), 256)
    return _let(_let(digest, blocks), replaced)


def pseudonym(m: Column, value: Column, key: str = KEY) -> Column:
    """(kinds, text) for a match, `value` for one that follows password= or token =; no kinds, and the same text, without a valid value."""
    made = {
        "secret": (value | m.rlike("^AKIA[0-9A-Z]{16}$"), F.lit(True), _scrambled(m, "secret", key)),
        "email": (m.contains("@"), F.lit(True), _scrambled(m, "email", key)),
    }
    for name, make in (("ip", _ip), ("phone", _phone), ("ssn", _ssn), ("date", _date)):
        made[name] = (m.rlike(f"^(?:{PATTERNS[name]})$"), *make(m, key))
    out = _cards(m, key)  # what fits nothing else is a run of digits
    for name, (fits, good, new) in reversed(made.items()):
        one = F.struct(F.when(good, F.array(F.lit(name))).otherwise(F.array().cast("array<string>")).alias("kinds"), F.when(good, new).otherwise(m).alias("text"))
        out = F.when(fits, one).otherwise(out)
    return out


def pseudonymised(docs: DataFrame, text: str = "text", key: str = KEY) -> tuple[DataFrame, str, str]:
    """docs with two more columns, and their names: the text with pseudonyms, and the kinds found, in order."""
    new, found = unused(docs, "private_text", "private_kinds")
    value = F.col(text)
    maybe = value.rlike(r'[0-9@]|password=|token = "|AKIA')  # every match of ANY has one of these
    matches = F.regexp_extract_all(value, F.lit(_MARKED), F.lit(0))
    marks = F.when(value.rlike(r'password=|token = "'), F.regexp_extract_all(value, F.lit(_MARKED), F.lit(1))).otherwise(F.array().cast("array<string>"))
    made = F.zip_with(matches, marks, lambda m, mark: pseudonym(m, F.coalesce(mark != "", F.lit(False)), key))
    out = docs.withColumn(found, F.when(maybe, made))
    parts = F.split(value, ANY, -1)
    after = F.zip_with(F.col(found), F.slice(parts, F.lit(2), F.size(found)), lambda p, part: F.concat(p["text"], part))
    put = F.concat(F.element_at(parts, 1), F.array_join(after, ""))
    out = out.withColumn(new, F.when(F.size(F.coalesce(F.col(found), F.array())) > 0, put).otherwise(value))
    kinds = F.flatten(F.transform(F.coalesce(F.col(found), F.array()), lambda p: p["kinds"]))
    return out.withColumn(found, kinds), new, found


def pseudonyms(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key: str = KEY) -> DataFrame:
    """One row a document: the text with pseudonyms, the number of values replaced, and their number by kind."""
    rows = docs.select(F.col(doc_id), F.col(text).cast("string").alias("text"))
    out, new, kinds = pseudonymised(rows, "text", key)
    by_kind = [F.size(F.array_remove(kinds, name)).alias(f"n_{name}") for name in KINDS]
    by_kind = [(F.size(kinds) - c).cast("bigint").alias(f"n_{name}") for c, name in zip(by_kind, KINDS, strict=True)]
    return out.select(doc_id, F.col(new).alias("text"), F.size(kinds).cast("bigint").alias("n_replaced"), *by_kind)
