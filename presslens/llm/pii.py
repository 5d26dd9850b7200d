"""Format-preserving pseudonyms for personal data, with DataFrame functions only.

Numbers and dates are validated, then permuted by a keyed Feistel network over exactly the set of valid values of their format:
a value is a pair (left, right) of mixed radix, and rounds add a keyed hash of one side to the other, modulo its radix. So a
pseudonym has the same format and is valid, no two values of a format share one, and equal values get equal
pseudonyms in every document, however they were punctuated. Punctuation stays where it was.

Kinds: payment card numbers (13 to 19 digits that pass the Luhn check, beside whatever other numbers; the check digit is made
anew; some sequences of plain numbers pass the check by chance and are replaced too), US social security
numbers, North American phone numbers (any area code, with or without separators), IPv4 addresses, dates of 1900 to 2099. Local part and domain of an e-mail
address, which have no numeric format, are replaced by keyed hashes.

Cases: texts and runs of any length are searched whole, in time in proportion to their length but for the number of hits in a text; of hits
that start together the kind named first wins; a null text stays null; an empty text, or one without such data, is unchanged; candidates that are not valid stay as
they are; repeated rows are treated alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm.common import documents, let

ROUNDS = 8
#: A local part starts where its run of characters does, or after the last hit, and is not given back; the domain is one run of
#: characters without two dots together. So long runs of either take time in proportion, and no stack.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@(?=[A-Za-z0-9-])(?:(?!\.\.)[A-Za-z0-9.-])*\.[A-Za-z]{2,}"
#: Digits in groups with single spaces or hyphens between them, 13 digits at least; cards are sought in it at the groups' ends.
RUN = r"(?<![0-9])(?<![0-9]\.)(?=(?:[ -]?[0-9]){13})[0-9]++(?:[ -][0-9]++)*+"
#: The lengths and first digits of known issuers, without groups of one or two digits; the usual ways to write a card number.
ISSUED = r"^(?:4(?:[0-9]{12}|[0-9]{15}|[0-9]{18})|(?:5[1-5]|2[2-7]|35)[0-9]{14}|3[47][0-9]{13}|3(?:0[0-5]|[689])[0-9]{11}|6[0-9]{15}(?:[0-9]{3})?)$"
SHORT_GROUP = r"(?:^|[ -])[0-9]{1,2}(?:[ -]|$)"
USUAL = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:\1[0-9]{3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})[ -]?$"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
#: With separators, or ten digits without any, if they are not the decimals of a number or part of a longer name (a hex string, say).
PHONE = r"(?<![0-9])(?!(?:(?<=[0-9]\.)|(?<=[A-Za-z_]))[0-9]{10,11}(?![0-9]))(?![0-9]{10,11}[A-Za-z_])(?:\+?1[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-]?)[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
IPV4 = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9/-])(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9-])|(?<![0-9/-])[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}(?![0-9/])"
EMAIL_OR_RUN = f"{EMAIL}|{RUN}"
OTHERS = "|".join((EMAIL, SSN, PHONE, IPV4, DATE))
#: 1900-01-01 to 2099-12-31 are 73,049 = 319 * 229 days.
DATE_RADIX = (319, 229)
KINDS = ("email", "card", "ssn", "phone", "ipv4", "date")


def keyed(key: str, tag: Column, value: Column) -> Column:
    """60 bits of a keyed hash."""
    said = F.concat_ws("|", F.lit(key), tag.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(F.concat(F.lit(key), F.sha2(said, 256)).cast("binary"), 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, radix_left: Column, radix_right: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the pairs (left, right) with sides below their radices."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(s: Column, i: Column) -> Column:
        tag = F.concat_ws(":", F.lit(kind), radix_left.cast("string"), i.cast("string"))
        odd = F.struct(s["l"].alias("l"), F.pmod(s["r"] + F.pmod(keyed(key, tag, s["l"]), radix_right), radix_right).alias("r"))
        even = F.struct(F.pmod(s["l"] + F.pmod(keyed(key, tag, s["r"]), radix_left), radix_left).alias("l"), s["r"].alias("r"))
        return F.when(i % 2 == 1, odd).otherwise(even)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def luhn_sum(digits: Column) -> Column:
    """Luhn sum with the last digit undoubled."""

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when((F.length(digits) - i) % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.split(digits, ""), worth), F.lit(0), lambda a, x: a + x)


def put_digits(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits``, in order."""
    place = F.length(shape)
    chars = F.transform(
        F.sequence(F.lit(1), place),
        lambda i: let(
            F.substring(shape, i, F.lit(1)),
            lambda c: F.when(c.rlike("[0-9]"), F.substring(digits, F.length(F.regexp_replace(F.substring(shape, F.lit(1), i), "[^0-9]", "")), F.lit(1))).otherwise(c),
        ),
    )
    return F.array_join(chars, "")


def only_digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def padded(number: Column, width: Column | int) -> Column:
    width = width if isinstance(width, Column) else F.lit(width)
    return F.lpad(number.cast("string"), width, F.lit("0"))


def card(hit: Column, key: str) -> Column:
    def permuted(d: Column) -> Column:
        n = F.length(d) - 1
        u = F.floor(n / 2).cast("int")
        v = n - u
        ten = F.lit(10.0)
        body = let(
            feistel(F.substring(d, F.lit(1), u), F.substring(d, u + 1, v), F.pow(ten, u).cast("long"), F.pow(ten, v).cast("long"), key, "card"),
            lambda s: F.concat(padded(s["l"], u), padded(s["r"], v)),
        )
        return let(body, lambda b: F.concat(b, F.pmod(F.lit(10) - luhn_sum(F.concat(b, F.lit("0"))) % 10, F.lit(10)).cast("string")))

    return let(only_digits(hit), lambda d: F.when(luhn_sum(d) % 10 == 0, put_digits(hit, permuted(d))).otherwise(hit))


def ssn(hit: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""

    def permuted(d: Column) -> Column:
        area, group, serial = (F.substring(d, a, n).cast("int") for a, n in ((1, 3), (4, 2), (6, 4)))
        index = (area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + group - 1
        valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)

        def back(s: Column) -> Column:
            a = F.floor(s["l"] / 99) + 1
            a = a + F.when(a >= 666, 1).otherwise(0)
            return put_digits(hit, F.concat(padded(a, 3), padded(s["l"] % 99 + 1, 2), padded(s["r"] + 1, 4)))

        return F.when(valid, let(feistel(index, serial - 1, F.lit(898 * 99), F.lit(9999), key, "ssn"), back)).otherwise(hit)

    return let(only_digits(hit), permuted)


def phone(hit: Column, key: str) -> Column:
    """The ten national digits: numbers that start with 2 to 9 and those with 0 or 1 are permuted apart; a leading country code stays."""

    def permuted(d: Column) -> Column:
        ten = F.substring(d, -10, 10)
        low = F.when(ten.rlike("^[01]"), F.lit(0)).otherwise(F.lit(20000))
        span = F.when(ten.rlike("^[01]"), F.lit(20000)).otherwise(F.lit(80000))
        pair = feistel(F.substring(ten, 1, 5).cast("long") - low, F.substring(ten, 6, 5), span, F.lit(100000), key, "phone")
        lead = F.substring(d, F.lit(1), F.length(d) - 10)
        return put_digits(hit, let(pair, lambda s: F.concat(lead, padded(s["l"] + low, 5), padded(s["r"], 5))))

    return let(only_digits(hit), permuted)


def ipv4(hit: Column, key: str) -> Column:
    octets = F.transform(F.split(hit, r"\."), lambda o: o.cast("long"))
    pair = let(octets, lambda o: feistel(F.get(o, 0) * 256 + F.get(o, 1), F.get(o, 2) * 256 + F.get(o, 3), F.lit(65536), F.lit(65536), key, "ipv4"))
    return let(pair, lambda s: F.concat_ws(".", *[x.cast("long").cast("string") for x in (F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256)]))


def date(hit: Column, key: str) -> Column:
    iso = hit.contains("-")
    day = F.when(iso, F.try_to_date(hit, "yyyy-MM-dd")).otherwise(F.try_to_date(hit, "dd/MM/yyyy"))
    a, b = DATE_RADIX

    def permuted(n: Column) -> Column:
        made = let(feistel(F.floor(n / b), n % b, F.lit(a), F.lit(b), key, "date"), lambda s: F.date_add(F.lit("1900-01-01").cast("date"), (s["l"] * b + s["r"]).cast("int")))
        return F.when(n.isNull(), hit).when(iso, F.date_format(made, "yyyy-MM-dd")).otherwise(F.date_format(made, "dd/MM/yyyy"))

    return let(F.datediff(day, F.lit("1900-01-01").cast("date")), permuted)


def email(hit: Column, key: str) -> Column:
    domain = F.lower(F.substring_index(hit, "@", -1))
    return F.concat(F.lit("u"), F.lower(F.hex(keyed(key, F.lit("local"), F.lower(hit)))), F.lit("@d"), F.lower(F.hex(keyed(key, F.lit("domain"), domain))), F.lit(".example"))


def kind_of(hit: Column) -> Column:
    """The kind that matched, by the order of the alternatives."""
    whole = [(EMAIL, "email"), (SSN, "ssn"), (PHONE, "phone"), (IPV4, "ipv4"), (DATE, "date")]
    out = None
    for pattern, name in whole:
        test = hit.rlike(f"^(?:{pattern})$")
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def piece(said: Column, kind: Column | None = None) -> Column:
    """A part of a text: the kind it was replaced as, "" if it is settled as it is, null if it is still to be searched."""
    return F.struct(said.alias("said"), (F.lit(None).cast("string") if kind is None else kind).alias("kind"))


def pseudonym(hit: Column, key: str) -> Column:
    makers = {"email": email, "ssn": ssn, "phone": phone, "ipv4": ipv4, "date": date}

    def made(kind: Column) -> Column:
        out = None
        for name, maker in makers.items():
            out = F.when(kind == name, maker(hit, key)) if out is None else out.when(kind == name, maker(hit, key))
        return let(F.coalesce(out, hit), lambda said: piece(said, F.when(said != hit, kind).otherwise("")))

    return let(kind_of(hit), made)


def cut(said: Column, pattern: str, of_hit) -> Column:
    """The pieces of a string: those between the matches, and for each match the array of pieces ``of_hit`` makes."""
    hits = F.regexp_extract_all(said, F.lit(f"({pattern})"), F.lit(0))
    pairs = F.zip_with(F.split(said, pattern, -1), hits, lambda plain, hit: F.when(hit.isNull(), F.array(piece(plain))).otherwise(F.concat(F.array(piece(plain)), of_hit(hit))))
    return F.flatten(pairs)


def searched(pieces: Column, of_open) -> Column:
    """Pieces with each open one replaced by the array of pieces that ``of_open`` makes of its string."""
    return F.flatten(F.transform(pieces, lambda p: F.when(p["kind"].isNull(), of_open(p["said"])).otherwise(F.array(p))))


def merged(pieces: Column) -> Column:
    """Open pieces side by side made one, so that what spans them is found."""

    def add(done: Column, p: Column) -> Column:
        last = F.element_at(done, -1)
        both = (F.size(done) > 0) & p["kind"].isNull() & F.try_element_at(done, F.lit(-1))["kind"].isNull()
        return F.when(both, F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(piece(F.concat(last["said"], p["said"]))))).otherwise(F.array_append(done, p))

    return F.aggregate(pieces, F.array().cast("array<struct<said:string,kind:string>>"), add)


def cards_in(run: Column, key: str, fits) -> Column:
    """The pieces of a run: cards are stretches of whole groups with 13 to 19 digits that ``fits`` and the Luhn check accept.

    From the left; of those that start at a group, one of 16 digits goes first, then the longest.
    """

    def of_groups(groups: Column) -> Column:
        n = F.size(groups)
        joined = lambda i, j: F.array_join(F.slice(groups, i, F.greatest(j - i + 1, F.lit(0))), "")

        def from_group(i: Column) -> Column:
            def stretch(j: Column) -> Column:
                return let(joined(i, j), lambda said: let(only_digits(said), lambda d: F.struct(F.when(F.length(d) == 16, 0).otherwise(20 - F.length(d)).alias("rank"), i.alias("i"), j.alias("j"), said.alias("said"), d.alias("d"))))

            every = F.transform(F.sequence(i, F.least(i + 18, n)), stretch)
            valid = F.filter(every, lambda w: F.when(F.length(w["d"]).between(13, 19), F.when(fits(w["said"], w["d"]), luhn_sum(w["d"]) % 10 == 0)).otherwise(False))
            return F.slice(F.array_sort(valid), 1, 1)

        def take(done: Column, w: Column) -> Column:
            gap = F.when(w["i"] > done["last"] + 1, F.array(piece(joined(done["last"] + 1, w["i"] - 1)))).otherwise(F.array().cast("array<struct<said:string,kind:string>>"))
            made = let(card(w["said"], key), lambda said: piece(said, F.when(said != w["said"], F.lit("card")).otherwise("")))
            more = F.struct(w["j"].alias("last"), F.concat(done["pieces"], gap, F.array(made)).alias("pieces"))
            return F.when(w["i"] > done["last"], more).otherwise(done)

        start = F.struct(F.lit(0).alias("last"), F.array().cast("array<struct<said:string,kind:string>>").alias("pieces"))
        found = F.flatten(F.transform(F.sequence(F.lit(1), n), from_group))
        ended = lambda done: F.when(done["last"] < n, F.array_append(done["pieces"], piece(joined(done["last"] + 1, n)))).otherwise(done["pieces"])
        return F.aggregate(found, start, take, ended)

    return let(F.regexp_extract_all(run, F.lit("([0-9]++[ -]?)"), F.lit(0)), of_groups)


def cards_first(hit: Column, key: str) -> Column:
    """Cards of known issuers, then cards in a usual form; e-mail addresses as they are replaced."""
    issued = cards_in(hit, key, lambda said, d: d.rlike(ISSUED) & ~said.rlike(SHORT_GROUP))
    return F.when(hit.contains("@"), F.array(pseudonym(hit, key))).otherwise(searched(issued, lambda run: cards_in(run, key, lambda said, d: said.rlike(USUAL))))


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """doc_id, text with pseudonyms, and the number of replaced values of each kind (``n_email`` and so on).

    A text is cut into pieces three times: by the cards that are surely cards, by the other kinds, and by whatever else in a run
    of digits passes the Luhn check. Only texts with an ``@`` or a digit are searched.
    """
    source = F.col(text)
    maybe = F.coalesce(source.rlike("[0-9@]"), F.lit(False))
    rows = docs.select("doc_id", source.alias("text"))
    first = F.when(F.col("text").rlike(RUN), merged(cut(F.col("text"), EMAIL_OR_RUN, lambda hit: cards_first(hit, key)))).otherwise(F.array(piece(F.col("text"))))
    rows = rows.withColumn("made", F.when(maybe, first))
    rows = rows.withColumn("made", searched(F.col("made"), lambda said: F.when(said.rlike("[0-9@]"), cut(said, OTHERS, lambda hit: F.array(pseudonym(hit, key)))).otherwise(F.array(piece(said)))))
    other_cards = lambda hit: cards_in(hit, key, lambda said, d: F.lit(True))
    rows = rows.withColumn("made", searched(F.col("made"), lambda said: F.when(said.rlike(RUN), cut(said, RUN, other_cards)).otherwise(F.array(piece(said)))))

    def replaced(kind: str) -> Column:
        return F.coalesce(F.size(F.filter("made", lambda p: p["kind"] == kind)), F.lit(0)).cast("long").alias(f"n_{kind}")

    joined = F.array_join(F.transform("made", lambda p: p["said"]), "")
    return rows.select("doc_id", F.when(F.col("made").isNull(), F.col("text")).otherwise(joined).alias("text"), *[replaced(k) for k in KINDS])


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is a parameter of the operator; this query uses a fixed one so that reruns agree."""
    return pseudonymise(documents(spark, sf_dir), key="presslens-query-key")
