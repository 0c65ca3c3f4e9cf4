"""License scan with ordered signature rules, on DataFrame functions only.

Texts are lower-cased (A-Z) and seen as words (runs of a-z, 0-9 and non-ASCII
characters).  Only texts with one of the rules' keywords are looked at further,
and each rule only where its own keyword occurs, or one of the words into which
its names run the keyword together with what stands beside it.  A rule is a regular expression
over the word line: every word stands between two blanks, ``' the  mit  license '``,
so words match whole and neighbouring matches share nothing.

Detections are intervals of words.  A detection is dropped if another one of at
least its priority contains its interval and is longer, or has the same interval
and comes earlier in (priority, rule order).  Detections of the three base
phrases are never dropped.

Defined results: null counts as empty; texts without words or detections have
zero counts, null positions, empty label strings and score 0; every row is
judged by itself, so repeated rows give repeated results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickspark.llm.common import read_table, text_or_empty, written

#: Word characters after lower-casing; the same set before it.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The base phrases and their labels.
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# License families - label, keyword (a word of every name), and the
# names by which texts call them (regular expressions over words).
FAMILIES = [
    ("0bsd", "0bsd", r"0bsd(?: license)?"),
    ("afl", "academic", r"academic free license"),
    ("agpl-1", "affero", r"affero general public license (?:version |v)?1(?: 0)?"),
    ("agpl-3", "affero", r"(?:gnu )?affero general public license (?:version |v)?3(?: 0)?"),
    ("agpl", "agpl", r"agpl(?: ?v?3)?"),
    ("apache-1", "apache", r"apache (?:software )?license (?:version )?1(?: [01])?"),
    ("apache-2", "apache", r"apache (?:license )?(?:version )?2(?: 0)?(?: license)?"),
    ("apache", "apache", r"apache (?:software )?license"),
    ("artistic-1", "artistic", r"artistic license (?:version )?1(?: 0)?"),
    ("artistic-2", "artistic", r"artistic license (?:version )?2(?: 0)?"),
    ("artistic", "artistic", r"artistic license"),
    ("beerware", "beerware", r"beerware(?: license)?"),
    ("bsd-2", "bsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd)(?: license)?"),
    ("bsd-3", "bsd", r"(?:modified bsd|new bsd|revised bsd|bsd 3 clause|3 clause bsd)(?: license)?"),
    ("bsd-4", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd)(?: license)?"),
    ("bsd", "bsd", r"bsd(?: style)? license"),
    ("boost-1", "boost", r"boost software license(?: version)?(?: 1(?: 0)?)?"),
    ("bsl-1", "business", r"business source license(?: 1 1)?"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by", "creative", r"creative commons attribution(?: [1-4] [05])?"),
    ("cc-by-sa", "creative", r"creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-by-nd", "creative", r"creative commons attribution no ?deriv(?:ative)?s?(?: [1-4] [05])?"),
    ("cc-by-nc", "creative", r"creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "creative", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1-4] [05])?"),
    ("cc0", "creative", r"creative commons zero"),
    ("cddl-1", "cddl", r"cddl(?: (?:version )?1(?: [01])?)?"),
    ("cddl-1", "distribution", r"common development and distribution license"),
    ("cecill", "cecill", r"cecill(?: [12] [01])?"),
    ("cpl-1", "common", r"common public license(?: (?:version )?1(?: 0)?)?"),
    ("ecl-2", "educational", r"educational community license(?: (?:version )?2(?: 0)?)?"),
    ("epl-1", "eclipse", r"eclipse public license (?:version |v)?1(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public license (?:version |v)?2(?: 0)?"),
    ("epl", "eclipse", r"eclipse public license"),
    ("eupl", "eupl", r"eupl(?: (?:version |v)?1 [12])?"),
    ("eupl", "european", r"european union public licen[cs]e"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation license"),
    ("gpl-2", "general", r"(?:gnu )?general public license (?:version |v)?2(?: 0)?"),
    ("gpl-3", "general", r"(?:gnu )?general public license (?:version |v)?3(?: 0)?"),
    ("gpl", "general", r"(?:gnu )?general public license"),
    ("gpl-2", "gpl", r"gpl ?(?:version |v)?2(?: 0)?"),
    ("gpl-3", "gpl", r"gpl ?(?:version |v)?3(?: 0)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("isc", "isc", r"isc license"),
    ("lgpl-2", "lesser", r"(?:gnu )?lesser general public license (?:version |v)?2(?: [01])?"),
    ("lgpl-3", "lesser", r"(?:gnu )?lesser general public license (?:version |v)?3(?: 0)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public license"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("lppl", "latex", r"latex project public license"),
    ("mit", "license", r"mit(?: style)? license"),
    ("mit-0", "attribution", r"mit no attribution(?: license)?"),
    ("mpl-1", "mozilla", r"mozilla public license (?:version |v)?1(?: [01])?"),
    ("mpl-2", "mozilla", r"mozilla public license (?:version |v)?2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public license"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa (?:open source )?license"),
    ("odbl", "database", r"open (?:data commons )?(?:open )?database license"),
    ("ofl", "font", r"(?:sil )?open font license"),
    ("openssl", "openssl", r"openssl license"),
    ("osl-3", "open", r"open software license(?: (?:version )?3(?: 0)?)?"),
    ("php", "php", r"php license"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("psf", "python", r"python software foundation license"),
    ("public-domain", "domain", r"public domain"),
    ("proprietary", "reserved", r"all rights reserved"),
    ("unlicense", "unlicense", r"unlicense"),
    ("upl", "universal", r"universal permissive license"),
    ("vim", "vim", r"vim license"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("zlib", "zlib", r"zlib(?: libpng)? license"),
    ("zpl", "zope", r"zope public license"),
]

# Keyword - the other words by which names of its families are known, where these lack the keyword.
TOGETHER = {
    "agpl": ["agpl3", "agplv3"],
    "bsd": ["freebsd"],
    "gpl": ["gpl2", "gpl3", "gplv2", "gplv3", "gplversion"],
}

# The ways a text puts a name ({} is the name) and their priority.
FORMS = [
    (4, r"spdx license identifier {}"),
    (3, r"(?:re)?licensed under (?:the )?(?:terms of the )?{}"),
    (3, r"(?:released|distributed|published|available|covered|free) under (?:the )?(?:terms of the )?{}"),
    (2, r"(?:terms|conditions) of the {}"),
    (2, r"subject to the {}"),
    (1, r"{}"),
]
#: Priority of a base phrase; above all forms.
BASE_PRIORITY = 5


def _spaced(pattern: str) -> str:
    """A pattern over single-blank words as one over the word line (two blanks between words)."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == " " and pattern[i + 1: i + 2] == "?":  # words that may be written together
            out.append("(?:  )?")
            i += 2
            continue
        out.append("  " if ch == " " else ch)
        i += 1
    return " " + "".join(out) + " "


def rules() -> list[tuple[int, int, str, str, str, bool]]:
    """(order, priority, label, keyword, pattern, is_base): base phrases, then every family in every form."""
    found = [(BASE_PRIORITY, label, {"mit": "license", "apache-2": "apache", "cc-by-nc": "cc"}[label], phrase, True)
             for phrase, label in BASE]
    found += [(priority, label, keyword, form.format(f"(?:{names})"), False)
              for priority, form in FORMS for label, keyword, names in FAMILIES]
    return [(i, p, label, keyword, _spaced(pattern), base) for i, (p, label, keyword, pattern, base) in enumerate(found)]


def gate_words() -> dict[str, str]:
    """Every word that opens the gate of a keyword's rules, with that keyword."""
    words = {r[3]: r[3] for r in rules()}
    return words | {word: keyword for keyword, together in TOGETHER.items() for word in together}


def keyword_gate() -> str:
    """A regular expression that finds any word of the gate as a whole word, in either case.

    The words are grouped by their first letter, so most places of a text are
    passed after one look.
    """
    starts: dict[str, list[str]] = {}
    for word in sorted(gate_words()):
        starts.setdefault(word[0], []).append(word[1:])
    words = "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in sorted(starts.items()))
    return f"(?i)(?<!{CASED_WORD[:-1]})(?:{words})(?!{CASED_WORD[:-1]})"


def word_line(text: Column) -> Column:
    """' w1  w2  w3 ': the lower-cased text's words, each between two blanks."""
    words = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))
    return F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" "))


def detections(lines: DataFrame) -> DataFrame:
    """(row, first, last, priority, rule, label, is_base) of every rule match in ``lines`` (row, line)."""
    table = lines.sparkSession.createDataFrame(rules(), "rule int, priority int, label string, keyword string, "
                                                        "pattern string, is_base boolean")
    gate = gate_words()
    keyword = F.create_map(*[F.lit(x) for pair in sorted(gate.items()) for x in pair])
    words = F.array_distinct(F.regexp_extract_all("line", F.lit(" (" + "|".join(sorted(gate)) + ") "), F.lit(1)))
    # several words may open one gate: each rule is looked at once
    keywords = F.array_distinct(F.transform(words, lambda w: F.element_at(keyword, w)))
    # the rules are a constant of this module: a few hundred rows
    gated = (lines.withColumn("keyword", F.explode(keywords)).join(F.broadcast(table), "keyword")
             .where(F.expr("line rlike pattern")))
    # what lies between the matches gives the word numbers they start at
    pieces = gated.select("row", "rule", "priority", "label", "is_base",
                          F.transform(F.expr("split(line, pattern, -1)"), _words_in).alias("gaps"),
                          F.transform(F.expr("regexp_extract_all(line, pattern, 0)"), _words_in).alias("hits"))
    spots = F.expr("""aggregate(sequence(1, size(hits)),
        named_struct('at', 0L, 'out', cast(array() as array<struct<a: bigint, b: bigint>>)),
        (s, i) -> named_struct('at', s.at + gaps[i - 1] + hits[i - 1],
                               'out', concat(s.out, array(named_struct(
                                   'a', s.at + gaps[i - 1], 'b', s.at + gaps[i - 1] + hits[i - 1] - 1)))),
        s -> s.out)""")
    return (pieces.withColumn("spot", F.explode(spots))
            .select("row", F.col("spot.a").alias("first"), F.col("spot.b").alias("last"), "priority", "rule", "label",
                    "is_base"))


def _words_in(line: Column) -> Column:
    """Number of words in a piece of the word line: a word has a blank on either side."""
    return ((F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))) / 2).cast("bigint")


def surviving(found: DataFrame, doc: str) -> DataFrame:
    """Detections that no other one of at least their priority contains (ties: earlier rule wins)."""
    # sorted by start and falling end, a container stands before what it contains
    spot = Window.partitionBy(doc).orderBy("first", F.desc("last"), F.desc("priority"), "rule").rowsBetween(
        Window.unboundedPreceding, -1)
    levels = sorted({p for p, _ in FORMS} | {BASE_PRIORITY})
    reach = F.coalesce(*[F.when(F.col("priority") == p, F.max(F.when(F.col("priority") >= p, F.col("last"))).over(spot))
                         for p in levels])
    return (found.withColumn("reach", reach)
            .where(F.col("is_base") | F.col("reach").isNull() | (F.col("reach") < F.col("last"))).drop("reach"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_words, the base phrases' places and all labels; see the module."""
    text = text_or_empty(text_col)
    # one scan of the texts: word counts of all, the word line of those with a keyword
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        F.regexp_count(text, F.lit(CASED_WORD)).cast("bigint").alias("n_words"),
        F.when(text.rlike(keyword_gate()), word_line(text)).alias("line")), "license-lines")
    found = detections(rows.where("line is not null").select("row", "line"))
    kept = surviving(found, "row")
    base = F.col("is_base")
    summary = kept.groupBy("row").agg(
        F.sum(base.cast("bigint")).alias("n_base"), F.min(F.when(base, F.col("first"))).alias("first_word"),
        F.max(F.when(base, F.col("first"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.count(F.lit(1)).alias("n_detections"))
    return (rows.select("row", "doc_id", "n_words")
            .join(summary, "row", "left").select(
                "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
                F.col("first_word").cast("bigint").alias("first_word"),
                F.col("last_word").cast("bigint").alias("last_word"),
                F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
                (1 - F.pow(F.lit(0.5), F.coalesce("n_detections", F.lit(0)).cast("double"))).alias("score")))


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def scan_sql() -> str:
    """The whole scan as DuckDB SQL over ``documents``, with the same rules."""
    opens = {k: [w for w, opened in sorted(gate_words().items()) if opened == k] for k in set(gate_words().values())}
    values = ",\n  ".join(f"({o}, {p}, '{label}', {opens[keyword]}, '{pattern}', {base})"
                          for o, p, label, keyword, pattern, base in rules())
    levels = sorted({p for p, _ in FORMS} | {BASE_PRIORITY})
    reach = " ".join(f"WHEN {p} THEN max(CASE WHEN priority >= {p} THEN last END) OVER before" for p in levels)
    count = "(length({0}) - length(replace({0}, ' ', ''))) // 2"
    total = lambda part: f"coalesce(list_sum(list_transform({part}, lambda x: {count.format('x')})), 0)"
    return f"""
WITH rules(rule, priority, label, opens, pattern, is_base) AS (VALUES
  {values}),
d AS (SELECT doc_id, row_number() OVER () AS row,
             regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words FROM documents),
l AS (SELECT *, ' ' || array_to_string(words, '  ') || ' ' AS line FROM d),
m AS (SELECT row, r.*, string_split_regex(line, pattern) AS gaps, regexp_extract_all(line, pattern) AS hits
      FROM l JOIN rules r ON list_has_any(words, opens) WHERE regexp_matches(line, pattern)),
i AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
f AS (SELECT row, rule, priority, label, is_base, {total('gaps[1:i]')} + {total('hits[1:i - 1]')} AS first,
             {total('gaps[1:i]')} + {total('hits[1:i]')} - 1 AS last FROM i),
s AS (SELECT *, CASE priority {reach} END AS reach FROM f
      WINDOW before AS (PARTITION BY row ORDER BY first, last DESC, priority DESC, rule
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT row, count(*) FILTER (WHERE is_base) AS n_base, min(first) FILTER (WHERE is_base) AS first_word,
             max(first) FILTER (WHERE is_base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE is_base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, count(*) AS n
      FROM s WHERE is_base OR reach IS NULL OR reach < last GROUP BY row)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, 1 - pow(0.5, coalesce(n, 0)) AS score
FROM d LEFT JOIN k USING (row)
"""
