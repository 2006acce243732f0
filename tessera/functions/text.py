"""Column-level text helpers: blank handling, labelled text, prompt and
predicate text, time stamps, image references.

Everything here returns a ``Column`` built from built-in functions, so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings of "no value" in transcribed inputs.
BLANK_TOKENS = ("nan", "none")
# The 19 tokens a pandas CSV reader turns into null.
CSV_NULL_TOKENS = (
    "", "NA", "N/A", "n/a", "NULL", "null", "NaN", "nan", "None", "#N/A",
    "#N/A N/A", "#NA", "-NaN", "-nan", "<NA>", "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN",
)
# The four place fields, their labels in the readable
# predicate and in the retrieval question.
PLACE_FIELDS = ("continent", "country", "state_province", "county")
PREDICATE_NAMES = {"continent": "Continent", "country": "Country",
                   "state_province": "stateProvince", "county": "County"}
QUESTION_LABELS = {"continent": "Continent", "country": "Country",
                   "state_province": "State or Province", "county": "County"}
# The retrieval prompt template and the context separator.
PROMPT_TEMPLATE = """
Answer the question based only on the following context:

{context}

---

Answer the question based on the above context: {question}
"""
CONTEXT_SEPARATOR = "\n\n---\n\n"
# The retrieval question of a place row, the instruction of the
# two jobs, and the templates that put context before an instruction.
QUESTION_TEMPLATE = ("Find a match for Continent like {continent}, Country like {country}, State or Province like {state_province}, "
                     "County like {county} {continent_text}, {country_text}, {state_province_text}, {county_text} must be included in the match")
INSTRUCTION_FIELDS = 'Find the nearest match to Continent="{continent}", Country="{country}", State/Province="{state_province}", County="{county}"\n'
ANSWER_SHAPE = '{"irn_eluts":"value1", "continent":"value2", "country":"value3", "state_province":"value4", "county":"value5"}'
RECONCILE_INSTRUCTION = (INSTRUCTION_FIELDS + "Return the nearest matching line together with the irn_eluts number as JSON of structure "
                         + ANSWER_SHAPE + "\nMake no commentDo not return newlines in the JSON")
RETRIEVE_INSTRUCTION = (INSTRUCTION_FIELDS + "Return the matching line together with the irn_eluts number as JSON of structure "
                        + ANSWER_SHAPE + "Do not return newlines in the JSON")
RECONCILE_TEMPLATE = ("Answer the question based on the following context:\n{context}\n"
                      "Answer the question based on the above context: {question}")
PLACE_TEMPLATE = """
    Answer the question based only on the following context:
    {context}
    ---
    Answer the question based on the above context: {question}
"""
HUMAN_PREFIX = "Human: "


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_blank(c, none_is_blank: bool = True) -> Column:
    """null, 'nan' (and 'none' unless ``none_is_blank=False``) -> ''.

    Case-sensitive and untrimmed, like the source data rules."""
    c = _c(c).cast("string")
    toks = list(BLANK_TOKENS) if none_is_blank else ["nan"]
    return F.coalesce(F.when(~c.isin(*toks), c), F.lit(""))


def labelled(c, label: str) -> Column:
    """'label=value', or '' for a blank value."""
    c = _c(c)
    return F.when(c != "", F.concat(F.lit(label + "="), c)).otherwise(F.lit(""))


def slots(template: str, names) -> list[str]:
    """The template cut at its ``{name}`` slots: odd entries are names."""
    return re.split(r"\{(" + "|".join(names) + r")\}", template)


def filled(template: str, **values) -> Column:
    """``template`` with every ``{name}`` slot replaced by its Column.  The
    template is cut once, so braces inside the values are never expanded."""
    parts = slots(template, values)
    return F.concat(*[_c(values[p]) if k % 2 else F.lit(p) for k, p in enumerate(parts) if p])


def question_text(continent, country, state_province, county) -> Column:
    """Retrieval question for one place row; blank slots are kept as they are."""
    values = dict(zip(PLACE_FIELDS, (continent, country, state_province, county), strict=True))
    texts = {f + "_text": labelled(v, QUESTION_LABELS[f]) for f, v in values.items()}
    return filled(QUESTION_TEMPLATE, **values, **texts)


def instruction_text(continent, country, state_province, county, template: str = RECONCILE_INSTRUCTION) -> Column:
    """Instruction naming the four fields and the JSON shape wanted back
    (``RECONCILE_INSTRUCTION`` or ``RETRIEVE_INSTRUCTION``)."""
    return filled(template, **dict(zip(PLACE_FIELDS, (continent, country, state_province, county), strict=True)))


def fill_template(template: str, context, question, prefix: str = "") -> Column:
    """Put ``question`` and ``context`` into ``template`` ({question},
    {context}), after ``prefix`` (``HUMAN_PREFIX`` for a chat transcript)."""
    return filled(prefix + template, context=context, question=question)


def predicate_text(continent, country, state_province, county) -> Column:
    """Readable conjunctive filter for one row, one clause per non-blank
    field; '' when every field is blank.  Kept as lineage, never executed."""
    vals = dict(zip(PLACE_FIELDS, (_c(x) for x in (continent, country, state_province, county))))
    clauses = []
    for f in PLACE_FIELDS:
        v = vals[f]
        name = PREDICATE_NAMES[f]
        if f == "county":
            body = F.concat(F.lit(f'({name}.str.contains("'), v, F.lit('"))'))
        else:
            body = F.concat(F.lit(f'({name} == "'), v, F.lit('")'))
        clauses.append(F.when(v != "", body))
    return F.concat_ws(" and ", *clauses)


def run_stamp(ts) -> Column:
    """Run id / file stamp 'yyyy-MM-ddTHH-mm-ss' from a timestamp column."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH-mm-ss")


def base64_plain(binary) -> Column:
    """base64 without the line breaks some Spark versions insert."""
    return F.regexp_replace(F.base64(_c(binary)), "[\\r\\n]", "")


def image_reference(source_type, path, content) -> Column:
    """URL as given, else a jpeg data URL of the file's bytes."""
    return F.when(_c(source_type) == "url", _c(path)).otherwise(
        F.concat(F.lit("data:image/jpeg;base64,"), base64_plain(content)))


TOKEN_SPLIT = "[ \\t\\r\\n]+"


def tokens(text, lower: bool = False) -> Column:
    """Whitespace tokens (space, tab, CR, LF), empty pieces dropped."""
    t = F.lower(_c(text)) if lower else _c(text)
    return F.filter(F.split(t, TOKEN_SPLIT), lambda x: x != "")


def token_count(text) -> Column:
    return F.size(tokens(text))


def answer_line(response, sources) -> Column:
    """'Response: ...' and 'Sources: ...' on two lines (a column instead of a print)."""
    return F.concat(F.lit("Response: "), _c(response), F.lit("\nSources: "), _c(sources))
