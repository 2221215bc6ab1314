"""Text functions of cleaning and enrichment, as column expressions; nothing here needs Python workers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .rx import FLAGS, IGNORE_CASE, ODD_CASES, capitalize, contains_any, count_contained, has_odd_case, let, like_any, lines, strip, word_count, words


def text_language(text: Column, domain: Column | None = None) -> Column:
    """By the domain's ending, else by telling words in the text, else English."""

    def by_words(lower):
        found = F.lit("english")
        for language, own in reversed(fixed.LANGUAGE_WORDS):
            found = F.when(contains_any(lower, own), language).otherwise(found)
        return found

    found = let(F.lower(text), by_words)
    if domain is not None:
        for suffix, language in reversed(fixed.SUFFIX_LANGUAGE):
            found = F.when(F.endswith(domain, F.lit(suffix)), language).otherwise(found)
    return found


def _by_language(line: Column, lower: Column, language: Column, patterns: dict[str, list[str]], odd: Column | None = None) -> Column:
    found = F.lit(False)
    for name, own in patterns.items():
        found = F.when(language == name, like_any(line, lower, own, odd)).otherwise(found)
    return found


def _paywall_line(stripped: Column, language: Column, odd: Column | None = None) -> Column:
    hits = F.transform(stripped, lambda x: let(F.lower(x), lambda lower: _by_language(x, lower, language, fixed.PAYWALL, odd)))
    return F.array_position(hits, True).cast("int")


def paywall_line(text: Column, language: Column) -> Column:
    """Number of the first line with a paywall notice, from 1; 0 if there is none."""
    return _paywall_line(F.transform(lines(text), strip), language)


def finished(text: Column) -> Column:
    """Runs of blank lines and spaces shortened; lines of one to three characters dropped."""
    text = F.regexp_replace(text, "\n{3,}", "\n\n")
    # a single space is what it would be replaced by
    text = F.regexp_replace(text, r" [ \t]++|\t[ \t]*+", " ")
    text = F.replace(text, F.lit(" \n"), F.lit("\n"))
    kept = F.filter(F.transform(lines(text), strip), lambda x: (F.char_length(x) > 3) | (x == ""))
    return strip(F.array_join(kept, "\n"))


def cleaned(text: Column, language: Column, stop_at_paywall: bool = True) -> Column:
    """The text up to its paywall without navigation, sharing, promotion, footers, links and notices."""

    def kept_lines(odd):
        def upto_paywall(whole):
            return let(_paywall_line(whole, language, odd), lambda cut: F.when(cut > 0, F.slice(whole, F.lit(1), F.greatest(cut - 1, F.lit(0)))).otherwise(whole))

        def dropped(line):
            return let(F.lower(line), lambda lower: _by_language(line, lower, language, fixed.DROPPED_LINES, odd) | like_any(line, lower, fixed.DROPPED_EVERYWHERE, odd))

        whole = F.transform(lines(text), strip)
        if stop_at_paywall:
            whole = let(whole, upto_paywall)
        return F.filter(whole, lambda x: (x == "") | ~dropped(x))

    # odd letters are looked for once a text, not once a line and list
    return finished(F.array_join(let(F.coalesce(has_odd_case(F.lower(text)), F.lit(False)), kept_lines), "\n"))


def cleaned_by_rules(text: Column, domain: Column, patterns: dict[str, list[str]]) -> Column:
    """First deletes what a domain's own patterns match (in their order), then cleans."""
    out = text
    for name, own in patterns.items():
        changed = text
        for pattern in own:
            changed = F.regexp_replace(changed, "(?iuUdm)" + pattern, "")
        out = F.when(domain == name, changed).otherwise(out)
    # text and language are bound once: named for each line they would be made anew for each line
    return let(out, lambda own: let(text_language(own, domain), lambda language: cleaned(own, language)))


def filled_lines(text: Column) -> Column:
    return F.size(F.filter(lines(text), lambda x: strip(x) != ""))


def markdown_repaired(text: Column) -> Column:
    """Joins emphasis broken by line ends, drops empty emphasis, spaces out markers and blank lines."""
    def where_held(pattern, to, need):
        held = lambda t: F.regexp_like(t, F.lit(need)) if need.startswith(r"\n[") else F.contains(t, F.lit(need))
        return lambda t: F.when(held(t), F.regexp_replace(t, FLAGS + pattern, to)).otherwise(t)

    for (pattern, to), need in zip(fixed.MARKDOWN_REPAIRS, fixed.REPAIRS_NEED):
        text = F.regexp_replace(text, FLAGS + pattern, to) if need is None else let(text, where_held(pattern, to, need))
    return text


def paragraphs(text: Column) -> Column:
    """A blank line where a line ends a sentence and the next one begins another."""

    def spaced(all_lines):
        return let(F.transform(all_lines, strip), lambda bare: F.transform(all_lines, lambda line, i: one(line, i, bare)))

    def one(line, i, bare):
        # only the ends of lines are looked at
        ends = F.substring(F.get(bare, i), -1, 1).isin(".", "!", "?", '"')
        start = F.substring(F.get(bare, i + 1), 1, 2)
        starts = F.regexp_like(start, F.lit(r"""\A["\p{Lu}\p{Lt}]""")) & ~F.regexp_like(start, F.lit(r"\A(?:[#>\-*]|[123]\.)"))
        return F.when(ends & starts, F.concat(line, F.lit("\n"))).otherwise(line)

    # lines are bound once: named inside the lambda they would be made anew for each line
    return F.array_join(let(lines(text), spaced), "\n")


def overlap(part: Column, whole: Column) -> Column:
    """Share of the part's distinct words that the whole has; null if either is empty or the part has under three."""
    own, other = F.array_distinct(words(F.lower(part))), F.array_distinct(words(F.lower(whole)))
    share = F.size(F.array_intersect(own, other)) / F.size(own)
    return F.when((part != "") & (whole != "") & (F.size(own) >= 3), share)


def unique_words(text: Column) -> Column:
    return F.size(F.array_distinct(words(text)))


def is_repetitive(text: Column) -> Column:
    return let(words(text), lambda own: (F.size(own) > 20) & (F.try_divide(F.size(F.array_distinct(own)), F.size(own)) < 0.1))


def _found(text: Column, pattern: str, held: Column | None = None) -> Column:
    """What the pattern finds; a text that does not hold what a match needs is not tried."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return found if held is None else F.when(held | text.isNull(), found).otherwise(F.array().cast("array<string>"))


#: One of these is in every company's name.
COMPANY_FORMS = ["SA", "Inc", "Corp", "Ltd", "AG", "GmbH"]


def _names(names: list[str]) -> str:
    return r"\b(?:" + "|".join(names) + r")\b"


def persons(text: Column) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.array(*(_found(text, FLAGS + p) for p in fixed.PERSONS)))))


def locations(text: Column, lower: Column | None = None) -> Column:
    lower = F.lower(text) if lower is None else lower
    held = lambda names: contains_any(lower, [*(n.lower() for n in names), *ODD_CASES])
    found = F.flatten(F.array(*(_found(text, IGNORE_CASE + _names(names), held(names)) for names in fixed.LOCATIONS)))
    return F.array_sort(F.array_distinct(F.transform(found, capitalize)))


def organizations(text: Column) -> Column:
    patterns = [*((_names(names), names) for names in fixed.ORGANIZATIONS), (fixed.COMPANY, COMPANY_FORMS)]
    return F.array_sort(F.array_distinct(F.flatten(F.array(*(_found(text, FLAGS + p, contains_any(text, parts)) for p, parts in patterns)))))


# Functions below take the text in lower case, or its number of words, where a caller has it as a column: inside a condition an expression is made anew each time it is named.


def entities(text: Column, lower: Column | None = None) -> Column:
    return F.struct(persons(text).alias("persons"), locations(text, lower).alias("locations"), organizations(text).alias("organizations"))


def sentiment(text: Column, lower: Column | None = None) -> Column:
    lower = F.lower(text) if lower is None else lower
    more = count_contained(lower, fixed.POSITIVE) - count_contained(lower, fixed.NEGATIVE)
    # as a place in a list, the counts are named once
    named = F.get(F.array(F.lit("negative"), F.lit("neutral"), F.lit("positive")), (F.signum(more) + 1).cast("int"))
    return F.coalesce(named, F.lit("neutral"))


def importance(text: Column, title: Column, lower: Column | None = None, total: Column | None = None) -> Column:
    """Score from 0 to 1, unrounded."""
    lower, total = F.lower(text) if lower is None else lower, word_count(text) if total is None else total
    score = F.lit(0.5) + F.when(total > 1000, 0.2).when(total > 500, 0.1).when(total < 100, -0.3).otherwise(0.0)
    score = score + F.least(count_contained(lower, fixed.IMPORTANT) * F.lit(0.05), F.lit(0.3))
    score = score + F.when(contains_any(lower, fixed.LOW_VALUE), -0.2).otherwise(0.0)
    score = score + F.when(contains_any(F.lower(F.coalesce(title, F.lit(""))), fixed.URGENT), 0.2).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def geographic_scope(text: Column, n_locations: Column, lower: Column | None = None) -> Column:
    lower = F.lower(text) if lower is None else lower
    national = contains_any(lower, fixed.SCOPE_NATIONAL) & ~F.contains(lower, F.lit("international"))
    return (
        F.when(contains_any(lower, fixed.SCOPE_LOCAL), "local")
        .when(national, "national")
        .when(contains_any(lower, fixed.SCOPE_INTERNATIONAL) | (n_locations > 2), "international")
        .otherwise("regional")
    )


def complexity(text: Column, lower: Column | None = None) -> Column:
    """Mean words a full-stop segment over 20, and share of distinct words; their mean, 1 at most, unrounded."""
    segments = F.char_length(text) - F.char_length(F.replace(text, F.lit("."), F.lit(""))) + 1
    # a word with full stops inside counts in each of its segments
    total = F.regexp_count(text, F.lit(r"(?U)[^\s\x1c-\x1f.]+"))
    # words are cut once: lower case makes no two words of one, nor one of two
    richness = let(words(F.lower(text) if lower is None else lower), lambda own: F.coalesce(F.try_divide(F.size(F.array_distinct(own)), F.size(own)), F.lit(0.0)))
    return F.least(F.lit(1.0), (total / segments / 20 + richness) / 2)


def summary(text: Column) -> Column:
    return F.concat(strip(F.array_join(F.slice(F.split(text, r"\."), 1, 3), ". ")), F.lit("."))


def topic(path: Column) -> Column:
    """Romanian topic name and score by keywords of a URL path."""
    kept = F.filter(F.split(F.btrim(path, F.lit("/")), "-"), lambda p: (p != "") & ~F.regexp_like(p, F.lit(r"(?U)^\d+\z")))
    prompt = F.lower(F.array_join(kept, " "))
    name = let(prompt, lambda p: F.coalesce(*(F.when(contains_any(p, own), name) for name, own in fixed.TOPICS), F.lit("general")))
    return let(name, lambda n: F.struct(n.alias("name"), F.when(n == "general", 0.5).otherwise(0.75).alias("score")))


def topic_label(found: Column) -> Column:
    return let(found, lambda x: F.concat(F.lit("Domeniu: "), x["name"], F.lit(" (scor: "), F.format_string("%.2f", x["score"]), F.lit(")")))


def category(label: Column) -> Column:
    name = strip(F.regexp_extract(label, r"Domeniu:([^(]*)", 1))
    names = F.create_map(*(F.lit(x) for pair in fixed.TOPIC_NAMES.items() for x in pair))
    return F.coalesce(F.try_element_at(names, name), F.lit("general"))


def content_type(text: Column) -> Column:
    lower = F.lower(text)
    return F.when(contains_any(lower, fixed.SHOPPING), "shopping_guide").when(contains_any(lower, fixed.ABOUT), "about_page").otherwise("news_article")


def content_confidence(kind: Column) -> Column:
    return F.when(kind == "shopping_guide", 0.7).when(kind == "about_page", 0.8).otherwise(0.5)


def rss_date(text: Column, now: Column) -> Column:
    """RFC 822 form of a date in one of four forms, with the empty zone's trailing space; else of now."""
    at = F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")), now)
    return F.concat(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" "))


def readable_bytes(n: Column) -> Column:
    out = F.format_string("%.1f TB", n / float(1024**4))
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        out = F.when(n < 1024 ** (power + 1), F.format_string(f"%.1f {unit}", n / float(1024**power))).otherwise(out)
    return out
