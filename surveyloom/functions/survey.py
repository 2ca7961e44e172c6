"""Survey text transforms as native column expressions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import vocab


def lookup(table: dict[str, str], key: Column) -> Column:
    """Value of a small fixed table, null where it has no such key."""
    # One expression, read by Spark in one call; it is folded to a map.
    quoted = ("'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for kv in table.items() for x in kv)
    return F.try_element_at(F.expr(f"map({', '.join(quoted)})"), F.coalesce(key, F.lit("")))


def label(c: Column) -> Column:
    """C11: lower case, white space collapsed and stripped."""
    return F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def simple_label(c: Column, keep: str = "") -> Column:
    """C11: the label without other than word characters and white space (parties keep a slash)."""
    return _simple(label(c), keep)


def _simple(normal: Column, keep: str = "") -> Column:
    """simple_label() of a text whose label is normal."""
    return F.regexp_replace(normal, rf"[^\p{{L}}\p{{N}}_\s{keep}]", "")


def once(value: Column, use) -> Column:
    """use(value) with the value evaluated a single time, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def day_first(c: Column) -> Column:
    """d.m.yyyy, d.m.yy or d. <German month> yyyy as a date; null where it is none."""
    named = r"^(\d{1,2})\.\s*(\p{L}+)\s+(\d{4})$"
    month = lookup({name: str(n) for name, n in vocab.MONTHS.items()}, F.regexp_extract(c, named, 2))
    spelled = F.try_to_date(F.concat_ws(".", F.regexp_extract(c, named, 1), month, F.regexp_extract(c, named, 3)), "d.M.yyyy")
    return F.when(c.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$"), F.try_to_date(c, "d.M.yyyy")).when(c.rlike(r"^\d{1,2}\.\d{1,2}\.\d{2}$"), F.try_to_date(c, "d.M.yy")).when(month.isNotNull(), spelled)


def iso_date(c: Column) -> Column:
    """The date part of an ISO date or timestamp text."""
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?$"), F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"))


def publish_date(c: Column) -> Column:
    """ISO date or timestamp, then day-first text; else null."""
    t = F.trim(c)
    return F.coalesce(iso_date(t), day_first(t))


def _dmy(day: Column, month: Column, year: Column) -> Column:
    """The date of groups of digits, the year's of four; null where it is none. Days are counted here, as a parser that fails costs more than all the rest of a row."""

    def date(x: Column) -> Column:
        d, m, y = x["d"], x["m"], x["y"]
        leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
        last = F.when(m.isin(4, 6, 9, 11), 30).when(m != 2, 31).when(leap, 29).otherwise(28)
        return F.when((m >= 1) & (m <= 12) & (d >= 1) & (d <= last) & (y >= 1), F.make_date(y, m, d))

    return once(F.struct(day.try_cast("int").alias("d"), month.try_cast("int").alias("m"), F.when(F.length(year) == 4, year.try_cast("int")).alias("y")), date)


#: A date of a time frame: day, perhaps month, perhaps year.
_DATE = r"\d{1,2}(?:\.\d{1,2}(?:\.\d{4}|\.)?|\.)?"


def _numbers(date: Column) -> Column:
    return F.filter(F.split(F.trim(date), r"\."), lambda x: x != "")


def timeframe(c: Column, default_year: Column | None = None) -> Column:
    """C4: struct(start, end, type, ignore) of a German time frame text.

    Two dates with a dash between them are a range; of several such pairs the first that are
    dates counts, so numbers of weeks or pages before it don't matter.  What the first date
    lacks of month and year it has from the second; what has no year has the default year, if
    there is one.  Before the dash white space may stand only after a year.  Where a first date
    of day and month doesn't exist, its last number is taken as a day of the second one's month.
    A first date without its last dot (``01.03–05.03.2024``) is still a day and a month.
    """
    s = F.trim(c)
    year = F.coalesce(default_year.cast("string") if default_year is not None else F.lit(None).cast("string"), F.lit(""))
    pairs = F.regexp_extract_all(s, F.lit(rf"{_DATE}\s*[-–]\s*{_DATE}"), F.lit(0))

    def parts(pair: Column) -> Column:
        return once(F.split(F.translate(pair, "–", "-"), "-"), lambda sides: F.struct(_numbers(F.get(sides, F.lit(0))).alias("l"), _numbers(F.get(sides, F.lit(1))).alias("r"), F.get(sides, F.lit(0)).rlike(r"\s$").alias("apart")))

    def span(x: Column) -> Column:
        l = lambda i: F.get(x["l"], F.lit(i))  # noqa: E731, E741
        r = lambda i: F.get(x["r"], F.lit(i))
        n = F.size(x["l"])
        dated, near = F.size(x["r"]) == 3, ~x["apart"]
        end = F.when(dated, _dmy(r(0), r(1), r(2))).when((F.size(x["r"]) == 2) & (n == 2) & near & (year != ""), _dmy(r(0), r(1), year))
        start = F.when(dated & (n == 3), _dmy(l(0), l(1), l(2))).when(dated & (n == 2) & near, F.coalesce(_dmy(l(0), l(1), r(2)), _dmy(l(1), r(1), r(2)))).when(dated & (n == 1) & near, _dmy(l(0), r(1), r(2)))
        return F.struct(F.coalesce(start, F.when(~dated, _dmy(l(0), l(1), year))).alias("start"), end.alias("end"))

    found = F.get(F.filter(F.transform(F.transform(pairs, parts), span), lambda x: x["start"].isNotNull() & x["end"].isNotNull()), F.lit(0))
    # A literal word is looked for without a pattern.
    marked = F.lit(False)
    for word in vocab.ELECTION_WORDS:
        marked = marked | F.lower(s).contains(word)
    single = F.when((year != "") & s.rlike(r"^\d{1,2}\.\d{1,2}\.?$"), _dmy(F.get(F.split(s, r"\."), F.lit(0)), F.get(F.split(s, r"\."), F.lit(1)), year))
    null = F.lit(None).cast("date")

    def made(kind: str, start: Column = null, end: Column = null, ignore: bool = False) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("type"), F.lit(ignore).alias("ignore"))

    def dated(found: Column) -> Column:
        until = (year != "") & F.lower(s).rlike(r"^bis\s+\d\d?\.\d\d?\.?$")
        return F.when(found.isNotNull(), made("VALID_RANGE", found["start"], found["end"])).when(until, made("BIS_PREFIX")).otherwise(once(single, lambda day: F.when(day.isNotNull(), made("SINGLE_DATE", day)).otherwise(made("INVALID"))))

    return (
        F.when(s.isNull() | (s == ""), made("INVALID")).when(s.contains("Uhr") & s.rlike(r"\d:\d\d"), made("TIME_RANGE", ignore=True)).when(s.contains("?"), made("UNKNOWN_DATE", ignore=True))
        .when(marked, made("ELECTION_MARKER", ignore=True)).otherwise(once(found, dated))
    )


def repaired(start: Column, end: Column, publish: Column, text: Column) -> Column:
    """struct(start, end) moved back a year where the text has no year and the dates run past publication or each other."""

    def moved(yearless: Column) -> Column:
        late = yearless & (end > publish)
        s, e = F.when(late, F.add_months(start, -12)).otherwise(start), F.when(late, F.add_months(end, -12)).otherwise(end)
        return F.struct(F.when(yearless & (s > e), F.add_months(s, -12)).otherwise(s).alias("start"), e.alias("end"))

    return once(~F.coalesce(text, F.lit("")).rlike(r"\b\d{4}\b") & publish.isNotNull(), moved)


def survey_window(start: Column, end: Column, text: Column, publish: Column) -> Column:
    """struct(start, end, ignore): explicit dates, completed from the time frame; ``bis`` leaves both null."""

    def window(x: Column) -> Column:
        frame, own_start, own_end = x["frame"], x["own_start"], x["own_end"]
        use = (own_start.isNull() | own_end.isNull()) & ~frame["ignore"]
        until = use & (frame["type"] == "BIS_PREFIX")
        return once(
            F.when(use, repaired(frame["start"], frame["end"], publish, text)),
            lambda fixed: F.struct(F.when(~until, F.coalesce(own_start, fixed["start"])).alias("start"), F.when(~until, F.coalesce(own_end, fixed["end"])).alias("end"), frame["ignore"].alias("ignore")),
        )

    return once(F.struct(timeframe(text, F.year(publish)).alias("frame"), publish_date(start).alias("own_start"), publish_date(end).alias("own_end")), window)


def digits(c: Column) -> tuple[Column, Column]:
    """(groups of digits, what stands before each of them and after the last) of a text: the groups in order, and one more gap."""
    return F.filter(F.split(c, "[^0-9]+"), lambda g: g != ""), F.split(c, "[0-9]+")


def respondents(c: Column) -> Column:
    """The first number.  After one to three digits a dot goes on with three more, as often as it does; of a longer group behind the last dot the rest is another number (``1.00325.02.``)."""

    def number(x: Column) -> Column:
        groups, gaps = x["groups"], x["gaps"]

        def longer(s: Column, i: Column) -> Column:
            g = F.get(groups, i)
            more = s["open"] & (F.get(gaps, i) == ".") & (F.length(g) >= 3)
            return F.struct(F.when(more, F.concat(s["text"], F.substring(g, 1, 3))).otherwise(s["text"]).alias("text"), (more & (F.length(g) == 3)).alias("open"))

        first = F.get(groups, F.lit(0))
        start = F.struct(first.alias("text"), (F.length(first) <= 3).alias("open"))
        rest = F.when(F.size(groups) > 1, F.sequence(F.lit(1), F.size(groups) - 1)).otherwise(F.array().cast("array<int>"))
        return F.when(first.isNotNull(), F.aggregate(rest, start, longer)["text"]).try_cast("int")

    groups, gaps = digits(c)
    return once(F.struct(groups.alias("groups"), gaps.alias("gaps")), number)


def method_hint(c: Column) -> Column:
    """Method key from the word before a bullet, else from the words after it; null if none."""
    before, after = F.substring_index(F.translate(c, "·", "•"), "•", 1), F.regexp_replace(c, r"^\s*[A-Za-z]+\s*[•·]", "")

    def said(text: Column) -> Column:
        out = F.when(F.lit(False), F.lit(""))
        for key, words in vocab.METHOD_WORDS:
            holds = F.lit(False)
            for word in words:
                holds = holds | text.contains(word)
            out = out.when(holds, key)
        return out

    return F.coalesce(F.when(c.rlike("[•·]"), lookup(vocab.METHOD_PREFIXES, F.upper(F.trim(before)))), once(F.lower(after), said))


def embedded_range(c: Column, publish: Column) -> Column:
    """struct(start, end) of the first two days with a dash between them in the text, in the year of publication.

    A day is a group of digits, of which the last two count (a number may stand before it), a
    dot, a month and a dot.
    """
    groups, gaps = digits(c)

    def found(x: Column) -> Column:
        groups, gaps, bare = x["groups"], x["gaps"], F.transform(x["gaps"], lambda g: F.translate(F.regexp_replace(g, r"\s", ""), "–", "-"))
        group, gap, plain = (lambda i: F.get(groups, i)), (lambda i: F.get(gaps, i)), (lambda i: F.get(bare, i))
        short = lambda i: F.length(group(i)) <= 2

        def days(i: Column) -> Column:
            dots = (gap(i + 1) == ".") & (gap(i + 3) == ".") & gap(i + 2).startswith(".") & gap(i + 4).startswith(".")
            return dots & (plain(i + 2) == ".-") & short(i + 1) & short(i + 2) & short(i + 3)

        at = F.filter(F.when(F.size(groups) > 3, F.sequence(F.lit(0), F.size(groups) - 4)).otherwise(F.array().cast("array<int>")), days)
        date = lambda i, n: _dmy(F.right(group(i + n), F.lit(2)), group(i + n + 1), F.year(publish).cast("string"))
        return F.get(F.transform(F.slice(at, 1, 1), lambda i: F.struct(F.when(publish.isNotNull(), date(i, 0)).alias("start"), F.when(publish.isNotNull(), date(i, 2)).alias("end"))), F.lit(0))

    none = F.lit(None).cast("date")
    return F.coalesce(once(F.struct(groups.alias("groups"), gaps.alias("gaps")), found), F.struct(none.alias("start"), none.alias("end")))


def parse_diagnostics(c: Column) -> Column:
    """What of count and method could not be read from a respondents text, with the text; null if both were."""
    missing = F.concat_ws(", ", F.when(respondents(c).isNull(), "count"), F.when(method_hint(c).isNull(), "method"))
    return F.when(F.coalesce(c, F.lit("")) == "", "Empty or invalid input").when(missing != "", F.concat(F.lit("Could not extract "), missing, F.lit(" from '"), c, F.lit("'")))


def unswapped(respondents_text: Column, frame: Column) -> Column:
    """struct(respondents, timeframe): a count in the time frame moves to empty respondents."""
    swap = (F.trim(F.coalesce(respondents_text, F.lit(""))) == "") & F.trim(frame).rlike(r"^\d+([.,]\d+)*$")
    return F.struct(F.when(swap, F.trim(frame)).otherwise(respondents_text).alias("respondents"), F.when(swap, None).otherwise(frame).alias("timeframe"))


def institute(c: Column) -> Column:
    """Alias, then name, each as label and as simple label, then an alias that contains or is contained, else UNKNOWN."""
    by_name = {x: key for key, name in reversed(vocab.INSTITUTES.items()) for x in (key.lower(), name.lower())}
    by_simple = {"".join(ch for ch in name.lower() if ch.isalnum() or ch in " _"): key for key, name in reversed(vocab.INSTITUTES.items())}

    def key(normal: Column) -> Column:
        near = F.when(F.lit(False), F.lit(""))
        for alias, key in vocab.INSTITUTE_ALIASES.items():
            near = near.when(normal.contains(alias) | F.lit(alias).contains(normal), key)
        named = once(_simple(normal), lambda simple: F.coalesce(lookup(vocab.INSTITUTE_ALIASES, simple), lookup(by_name, normal), lookup(by_simple, simple)))
        return F.when(F.coalesce(normal, F.lit("")) == "", "UNKNOWN").otherwise(F.coalesce(lookup(vocab.INSTITUTE_ALIASES, normal), named, near, F.lit("UNKNOWN")))

    return once(label(c), key)


def method(c: Column) -> Column:
    """Alias, key, then key words, else UNBEKANNT."""
    # Names of the methods' keys.
    names = {"online": "ONLINE", "telefonisch": "TELEFONISCH", "telefon_online": "TELEFON_ONLINE", "persoenlich": "PERSOENLICH", "persönlich": "PERSOENLICH", "unbekannt": "UNBEKANNT"}

    def key(n: Column) -> Column:
        words = F.when(n.contains("telefon") & n.contains("online"), "TELEFON_ONLINE").when(n.contains("telefon"), "TELEFONISCH").when(n.contains("online"), "ONLINE").when(n.contains("persönlich") | n.contains("persoenlich"), "PERSOENLICH")
        return F.coalesce(lookup(vocab.METHOD_ALIASES, n), lookup(names, n), words, F.lit("UNBEKANNT"))

    return once(label(c), key)


def state(c: Column) -> Column:
    """C14: area key by alias, then by simple label, then by key and name; else BUND."""
    spelled = {f"{key.lower()} | ({name.lower()})": key for key, name in vocab.STATE_NAMES.items()}
    return once(label(c), lambda normal: F.coalesce(lookup(vocab.STATE_ALIASES, normal), lookup(vocab.STATE_ALIASES, _simple(normal)), lookup(spelled, normal), F.lit("BUND")))


def scope_code(c: Column) -> Column:
    """C14: federal, nrw, or the lower-cased key."""
    return once(state(c), lambda key: F.when(key == "BUND", "federal").when(key == "NW", "nrw").otherwise(F.lower(key)))


def election(scope: Column, election_text: Column) -> Column:
    """struct(key, type, scope)."""
    key = state(scope)
    eu = label(election_text) == "europawahl"
    return F.struct(
        F.when(eu, "EU_WAHLEN").otherwise(key).alias("key"),
        F.when(eu, "Europawahl").when(key.isin("BUND", "OST", "WEST"), "Bundestagswahl").otherwise("Landtagswahl").alias("type"),
        F.when(eu, "eu").otherwise(scope_code(scope)).alias("scope"),
    )


def party(c: Column) -> Column:
    """Party key by label, then by the label without other signs than slashes; null if none."""
    return once(label(c), _party)


def _party(normal: Column) -> Column:
    return F.coalesce(lookup(vocab.PARTY_ALIASES, normal), lookup(vocab.PARTY_ALIASES, _simple(normal, "/")))


def is_non_result(c: Column) -> Column:
    """Whether a label stands for no party."""
    return label(c).isin(vocab.NON_RESULT_LABELS)


def party_result(name: Column, value: Column) -> Column:
    """struct(party, percentage, other) of a label and its text; other: the label stands for no party."""
    return once(label(name), lambda normal: F.struct(_party(normal).alias("party"), percentage(value).alias("percentage"), normal.isin(vocab.NON_RESULT_LABELS).alias("other")))


def percentage(c: Column) -> Column:
    """C17: a number, the middle of a range, else the sum of all numbers; null for dashes and texts without one.

    Commas are dots.  The text is cut at what is no digit or dot; a piece is one number, or
    where it holds several dots a number for every two of its parts.
    """
    text = F.trim(F.translate(c, ",%\u00a0", ".  "))
    none = F.struct(F.lit(0.0).alias("sum"), F.lit("").alias("open"))

    def part(s: Column, x: Column) -> Column:
        whole = F.coalesce(F.nullif(s["open"], F.lit("")).try_cast("double"), F.lit(0.0))
        both = (s["open"] != "") & (x != "")
        total = F.when(both, s["sum"] + F.concat(s["open"], F.lit("."), x).try_cast("double")).when(x == "", s["sum"] + whole).otherwise(s["sum"])
        return F.struct(total.alias("sum"), F.when(both, "").otherwise(x).alias("open"))

    def value(piece: Column) -> Column:
        end = F.aggregate(F.split(piece, r"\."), none, part)
        return end["sum"] + F.coalesce(F.nullif(end["open"], F.lit("")).try_cast("double"), F.lit(0.0))

    def number(t: Column, pieces: Column) -> Column:
        total = F.aggregate(pieces, F.lit(0.0), lambda s, p: s + value(p))
        plain = F.forall(pieces, lambda p: p.try_cast("double").isNotNull() & ~p.startswith(".") & ~p.endswith("."))
        between = F.regexp_replace(F.translate(t, "0123456789.", ""), r"\s", "")
        # Two numbers with nothing but a dash and blanks between them: digits stand at both ends.
        span = (F.size(pieces) == 2) & between.isin("-", "–") & plain & ~F.left(t, F.lit(1)).isin("-", "–") & ~F.right(t, F.lit(1)).isin("-", "–")
        return F.when(span, total / 2).when(F.size(pieces) > 0, total)

    def read(t: Column) -> Column:
        pieces = F.filter(F.split(t, "[^0-9.]+"), lambda p: F.translate(p, ".", "") != "")
        return F.when(t.rlike(r"^[0-9]+(\.[0-9]+)?$"), t.try_cast("double")).otherwise(once(pieces, lambda pieces: number(t, pieces)))

    return once(text, read)


def timestamp(c: Column) -> Column:
    """C20: ISO timestamp, Z allowed; bad text is null."""
    return F.try_to_timestamp(F.regexp_replace(c, "Z$", "+00:00"))


def public_election_key(c: Column) -> Column:
    """Public key of an election."""
    return F.coalesce(lookup(vocab.ELECTION_KEYS, c), F.lower(c))


def public_election_name(c: Column) -> Column:
    """Public name of an election type."""
    return F.coalesce(lookup(vocab.ELECTION_NAMES, c), c)


def public_id(kind: str, c: Column) -> Column:
    """R or C and at least eight digits; longer ids are not cut."""
    return F.when(c.isNotNull(), F.format_string(f"{kind}%08d", c.cast("long")))
