"""The registry and the shared SQL views of the checks.

A check is one DuckDB statement.  Views are kept by name; ``compose`` puts the
ones a statement mentions, and those they mention, in front of it.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quizlake.functions import values as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = {}


def view(name: str, sql: str) -> None:
    VIEWS[name] = sql.strip()


def _mentioned(sql: str) -> list[str]:
    return [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]


def compose(sql: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for inner in _mentioned(VIEWS[name]):
            if inner != name:
                visit(inner)
        ordered.append(name)

    for name in _mentioned(sql):
        visit(name)
    if not ordered:
        return sql.strip()
    parts = ",\n".join(f"{n} as materialized (\n{VIEWS[n]}\n)" for n in ordered)
    return f"with recursive {parts}\n{sql.strip()}"


def query(name: str, check: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if check is not None:
            ORACLES[name] = compose(check)
        return fn

    return register


# -- SQL fragments, the same expressions as the Spark columns ----------------------


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def inlist(words: list[str]) -> str:
    return "(" + ", ".join(lit(w) for w in words) + ")"


def sql_list(words: list[str]) -> str:
    return "[" + ", ".join(lit(w) for w in words) + "]"


def s_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def s_collapse(x: str) -> str:
    return rf"regexp_replace({x}, '\s+', ' ', 'g')"


def s_clean(x: str) -> str:
    return f"translate(lower(coalesce({x}, '')), {lit(V.PUNCTUATION)}, '')"


def s_clean_end(x: str) -> str:
    return f"regexp_replace({s_collapse(x)}, '^[ ,.;:]+|[ ,.;:]+$', '', 'g')"


def s_strip_marks(x: str) -> str:
    return f"regexp_replace({x}, '^[ ,]+|[ ,]+$', '', 'g')"


def s_norm_candidate(x: str) -> str:
    bare = rf"regexp_replace({s_strip(s_collapse(x))}, '^[ ,.;:()\[\]]+|[ ,.;:()\[\]]+$', '', 'g')"
    return s_strip(rf"regexp_replace({bare}, '(?i)^(the|a|an)\s+', '')")


def s_norm_question(x: str) -> str:
    tidy = rf"regexp_replace({s_clean_end(x)}, '\?+', '?', 'g')"
    return f"case when {tidy} like '%?' then {tidy} else {tidy} || '?' end"


def s_lower_first(x: str) -> str:
    return (
        f"case when regexp_matches({x}, '^[A-Z][^a-z]') then {x} "
        f"else lower(substr({x}, 1, 1)) || substr({x}, 2) end"
    )


def s_alnum(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z0-9]+')"


def s_apos(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z0-9'']+')"


def s_alpha(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[a-z'']+')"


def s_terms(x: str) -> str:
    return rf"regexp_extract_all({x}, '\b\w\w+\b')"


def s_words(x: str) -> str:
    return rf"list_filter(string_split_regex({x}, '\s+'), lambda w: w <> '')"


def s_key(x: str) -> str:
    return f"array_to_string({s_alnum(x)}, ' ')"


def s_contains_key(container: str, phrase: str) -> str:
    return f"({phrase} <> '' and contains(' ' || {container} || ' ', ' ' || {phrase} || ' '))"


def s_leak(option: str, answer: str) -> str:
    return s_contains_key(s_key(option), s_key(answer))


def s_usable(option: str, answer: str | None) -> str:
    text = s_strip(s_collapse(f"coalesce({option}, '')"))
    ok = (
        f"({s_key(text)} <> '' and {s_key(text)} not in {inlist(V.NULL_WORDS)} "
        f"and length({text}) <= 220 and len({s_alnum(text)}) <= 32"
    )
    if answer is not None:
        ok += f" and (coalesce({answer}, '') = '' or not {s_leak(text, answer)})"
    return ok + ")"


def s_ratio(left: str, right: str) -> str:
    return (
        f"case when len(list_distinct({left})) > 0 then "
        f"len(list_intersect({left}, {right}))::double / len(list_distinct({left})) else 0.0::double end"
    )


def s_bigrams(tokens: str) -> str:
    return (
        f"list_distinct(list_transform(range(1, len({tokens})), "
        f"lambda i: ({tokens})[i] || ' ' || ({tokens})[i + 1]))"
    )


def s_verb(tokens: str) -> str:
    return (
        f"len(list_filter({tokens}, lambda t: t in {inlist(V.VERBS)} "
        f"or (length(t) > 4 and regexp_matches(t, '(ed|ing|es)$')))) > 0"
    )


def s_bad_question(q: str) -> str:
    tk = s_apos(q)
    return (
        f"(len({tk}) < 5 or coalesce(({tk})[2] in {inlist(V.RANKER_SECOND)}, false) "
        f"or coalesce(({tk})[-1] in {inlist(V.RANKER_LAST)}, false) "
        f"or regexp_matches({q}, {lit(V.WH_PREPOSITION_RE)}))"
    )


def s_readable(q: str) -> str:
    tidy = "(" + s_clean_end(rf"regexp_replace({q}, '\?+$', '')") + " || '?')"
    w = s_alpha(tidy)
    return (
        f"(len({w}) >= 5 and not coalesce(({w})[2] in {inlist(V.GATE_SECOND)}, false) "
        f"and not coalesce(({w})[-1] in {inlist(V.GATE_LAST)}, false) "
        f"and {s_verb(f'({w})[2:]')} and not regexp_matches({tidy}, {lit(V.WH_PREPOSITION_RE)}))"
    )


def s_wh(q: str) -> str:
    first = f"({s_apos(q)})[1]"
    return f"case when {first} in {inlist(V.WH_WORDS)} then {first} else '' end"


def s_looks_person(text: str, sentence: str) -> str:
    return (
        f"(regexp_matches(lower({sentence}), {lit('|'.join(V.PERSON_CLUES))}) "
        f"or regexp_matches({text}, {lit(V.HYPHEN_NAME_RE)}))"
    )


def s_option_category(text: str, question: str) -> str:
    bare = s_strip(text)
    low = f"lower({bare})"
    start = f"regexp_extract(lower({question}), '[a-z0-9]+')"
    cues = "|".join(c.replace(".", r"\.") for c in V.DEGREE_CUES)
    return f"""case
      when regexp_matches({low}, {lit(cues)}) then 'educationDegree'
      when regexp_matches({low}, {lit(V.FULL_DATE_LOWER_RE)}) then 'date'
      when regexp_matches({low}, {lit(V.FULL_NUMBER_RE)}) then 'number'
      when {start} = 'when' then 'date'
      when {start} = 'who' then 'person'
      when {start} = 'where' then 'location'
      when regexp_matches({bare}, {lit(V.FULL_ACRONYM_RE)}) then 'acronym'
      when regexp_matches({bare}, {lit(V.FULL_PROPER_RE)}) then 'properNoun'
      when len({s_alnum(bare)}) >= 6 then 'statement'
      else 'term' end"""


def s_answer_category(text: str, kind: str, sentence: str, question: str) -> str:
    inferred = s_option_category(text, question)
    return f"""case
      when {kind} = 'date' then 'date'
      when {kind} = 'person' or {s_looks_person(text, sentence)} then 'person'
      when {kind} = 'location' then 'location'
      when {kind} in ('acronym', 'definition', 'properNoun') and ({inferred}) = 'term' then {kind}
      else {inferred} end"""


def s_answer_kind(answer: str, sentence: str) -> str:
    text = s_strip(answer)
    clue = r"(?i)\b(" + "|".join(V.PERSON_CLUES_FREE) + r")\b"
    return f"""case
      when regexp_matches({text}, {lit(V.FULL_DATE_RE)}) then 'date'
      when regexp_matches({text}, {lit(V.FULL_ACRONYM_RE)}) then 'acronym'
      when regexp_matches({sentence}, {lit(clue)}) then 'person'
      when regexp_matches({text}, {lit(V.FULL_PROPER_RE)}) then 'properNoun'
      else 'keyword' end"""


def s_mask_first(text: str, answer: str, blank: str) -> str:
    at = f"strpos(lower({text}), lower({answer}))"
    return (
        f"case when {answer} <> '' and {at} > 0 then substr({text}, 1, {at} - 1) || {lit(blank)} "
        f"|| substr({text}, {at} + length({answer})) else {text} end"
    )


def s_escape(x: str) -> str:
    return rf"regexp_replace({x}, '([^A-Za-z0-9_ ])', '\\\1', 'g')"


def s_mask_all(text: str, answer: str, blank: str) -> str:
    return (
        f"case when {answer} = '' then {text} else "
        f"regexp_replace({text}, '(?i)' || {s_escape(answer)}, {lit(blank)}, 'g') end"
    )


def s_bucket(key: str) -> str:
    return f"(cast('0x' || substr(md5({key}), 1, 8) as bigint) % 100)"


def s_compat(a: str, b: str, relaxed: bool) -> str:
    out = f"case when {a} = {b} then 1.0::double"
    if relaxed:
        for x, y, s in V.RELAXED_PAIRS:
            out += f" when {a} = {lit(x)} and {b} = {lit(y)} then {s}::double"
    return out + " else 0.0::double end"


def s_length_compat(a: str, b: str) -> str:
    return (
        f"greatest(0.0::double, 1.0::double - abs(ln(1 + greatest(len({s_alnum(a)}), 1)) "
        f"- ln(1 + greatest(len({s_alnum(b)}), 1))) / 2.4::double)"
    )


def s_lexical_cosine(a: str, b: str) -> str:
    la, lb = f"list_distinct({s_words(s_clean(a))})", f"list_distinct({s_words(s_clean(b))})"
    return (
        f"case when len({la}) * len({lb}) > 0 then len(list_intersect({la}, {lb})) "
        f"/ sqrt((len({la}) * len({lb}))::double) else 0.0::double end"
    )


def s_f1(a: str, b: str) -> str:
    la, lb = s_apos(a), s_apos(b)
    return (
        f"case when len(list_distinct({la})) + len(list_distinct({lb})) > 0 then "
        f"2.0::double * len(list_intersect({la}, {lb})) "
        f"/ (len(list_distinct({la})) + len(list_distinct({lb}))) else 0.0::double end"
    )


# -- shared views ---------------------------------------------------------------------

view(
    "v_parts",
    """
select p_partkey, p_name, p_type,
       upper(substr(p_name,1,1)) || substr(p_name,2,strpos(p_name,' ')-2) as first,
       upper(substr(p_name,1,1)) || substr(p_name,2,strpos(p_name,' ')-2) || ' '
         || upper(substr(p_name,strpos(p_name,' ')+1,1)) || substr(p_name,strpos(p_name,' ')+2) as nm,
       substr(r_name,1,1) || lower(substr(r_name,2)) as rg,
       cast(1900 + p_size as varchar) as yr
from part join region on p_partkey % 5 = r_regionkey
""",
)

PART_ARTICLE = """
'In July ' || yr || ', during ' || first || '''s campaign, a soldier named ' || nm
|| ' discovered a large slab in the city of ' || rg || '. It is widely known as the ' || p_name
|| ' of the valley, because it generates most of the supply. The ' || p_type
|| ' panel provided the translation needed to unlock the script. ' || nm
|| ' Agency was launched near ' || rg || ' Harbor in ' || yr
|| '. The treaty was signed at the University of ' || rg || '.'
"""

view(
    "v_passages",
    rf"""
select 'p' || p_partkey as doc_id, {PART_ARTICLE} as article from v_parts
union all
select 'd' || doc_id, regexp_replace(text, '[^\x00-\x7F]', '', 'g') from documents
""",
)

view(
    "v_raw",
    rf"""
with t as (
  select doc_id, article, regexp_extract_all(lower(article), '[a-z0-9]+') as tk
  from (select doc_id, regexp_replace(text, '[^\x00-\x7F]', '', 'g') as article from documents)
), q as (
  select 'd' || doc_id as row_id,
    case when doc_id % 50 <> 13 then article end as article,
    case when doc_id % 50 <> 11 then
      case doc_id % 6
        when 0 then 'Which answer best completes this sentence: ' || concat_ws(' ', tk[1], tk[2], tk[3], '_____', tk[7], tk[8]) || '?'
        when 1 then 'What comes between ' || tk[3] || ' and ' || tk[7] || '?'
        when 2 then 'Who wrote ' || concat_ws(' ', tk[1], tk[2], tk[3], '_____', tk[7], tk[8]) || ' ?'
        when 3 then 'Where is ' || concat_ws(' ', tk[1], tk[2], tk[3], '_____', tk[7], tk[8]) || ' found?'
        when 4 then 'Complete the sentence: ' || concat_ws(' ', tk[1], tk[2], tk[3], '_____', tk[7], tk[8])
        else 'How does the passage continue after ' || tk[1] || ' ' || tk[2] || '?' end
    end as question,
    case when len(tk) >= 20 then concat_ws(' ', tk[4], tk[5], tk[6]) end as ans,
    case when len(tk) >= 20 then concat_ws(' ', tk[10], tk[13], tk[16]) end as d1,
    case when len(tk) >= 20 then concat_ws(' ', tk[11], reverse(tk[14]), tk[17]) end as d2,
    case when len(tk) >= 20 then concat_ws(' ', reverse(tk[12]), tk[15], reverse(tk[18])) end as d3,
    substr('ABCD', (doc_id % 4)::int + 1, 1) as label,
    case when doc_id % 50 = 7 then 'E' when doc_id % 50 = 9 then ' ' || substr('ABCD', (doc_id % 4)::int + 1, 1) || ' '
         else substr('ABCD', (doc_id % 4)::int + 1, 1) end as answer
  from t
  union all
  select 'p' || p_partkey, {PART_ARTICLE},
    case p_partkey % 3 when 0 then 'Which name was given to the soldier?'
      when 1 then 'Who discovered a large slab in the city of ' || rg || '?'
      else 'What agency was launched near ' || rg || ' Harbor?' end,
    nm,
    case when p_partkey % 3 = 2 then 'the ' || p_name || ' of the valley' else rg || ' Harbor' end,
    case when p_partkey % 3 = 0 then p_type else yr end,
    first || ' ' || rg,
    substr('ABCD', (p_partkey % 4)::int + 1, 1),
    substr('ABCD', (p_partkey % 4)::int + 1, 1)
  from v_parts
)
select row_id, article, question,
  case when label = 'A' then ans else d1 end as "A",
  case when label = 'B' then ans when label > 'B' then d2 else d1 end as "B",
  case when label = 'C' then ans when label > 'C' then d3 else d2 end as "C",
  case when label = 'D' then ans else d3 end as "D",
  answer
from q
""",
)

view(
    "v_loaded",
    f"""
select *, coalesce(case {s_strip("coalesce(answer, '')")}
    when 'A' then "A" when 'B' then "B" when 'C' then "C" when 'D' then "D" end, '') as correct_answer
from v_raw
""",
)

view(
    "v_mcq",
    f"""
select row_id, article, question, "A", "B", "C", "D", {s_strip('answer')} as answer, correct_answer
from v_loaded
where article is not null and question is not null and answer is not null
  and {s_strip('answer')} in ('A', 'B', 'C', 'D') and correct_answer <> ''
""",
)

view(
    "v_options",
    """
select row_id, article, question, answer, correct_answer, l.label,
  case l.label when 'A' then "A" when 'B' then "B" when 'C' then "C" else "D" end as option_text,
  (answer = l.label)::int as is_correct
from v_mcq, (values ('A'), ('B'), ('C'), ('D')) l(label)
""",
)

view(
    "v_sent",
    rf"""
with p as (
  select doc_id, list_filter(list_transform(
    string_split(regexp_replace({s_strip("coalesce(article, '')")}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
    lambda x: {s_strip('x')}), lambda x: x <> '') as parts
  from v_passages)
select doc_id, unnest(range(len(parts))) as sent_idx, unnest(parts) as sentence from p
""",
)


def _emission(kind: str, order: int, pattern: str, group: int, extra: str = "") -> str:
    found = f"regexp_extract_all(sentence, {lit(pattern)}, {group})"
    return (
        f"select doc_id, sent_idx, sentence, '{kind}' as kind, {order} as pat, "
        f"unnest(range(len({found}))) as mat, unnest({found}) as raw from v_sent {extra}"
    )


view(
    "v_found",
    f"""
with r as (
  {_emission('date', 0, V.DATE_RE, 0)}
  union all {_emission('acronym', 1, V.ACRONYM_RE, 0)}
  union all {_emission('person', 2, V.POSSESSIVE_RE, 1)}
  union all {_emission('properNoun', 3, V.PROPER_RE, 0)}
  union all {_emission('definition', 4, V.DEFINITION_HEAD + V.DEFINITION_TAIL, 1)}
  union all {_emission('location', 5, V.LOCATION_RE, 1)}
), n as (
  select doc_id, sent_idx, sentence, kind, pat, mat, raw, {s_norm_candidate('raw')} as text from r
  where (kind <> 'definition' or len({s_words("regexp_replace(raw, '^[ ,;]+|[ ,;]+$', '', 'g')")}) >= 2)
    and (kind <> 'location' or (length({s_strip('raw')}) > 3 and (
         len({s_words(s_strip('raw'))}) >= 2
         or len(list_intersect({s_words(s_strip('lower(raw)'))}, {sql_list(V.GEO_WORDS)})) > 0)))
)
select *, case kind {' '.join(f"when '{k}' then {v}::double" for k, v in V.BASE_SCORE.items())} end
    + greatest(0.0::double, 1.0::double - sent_idx * 0.1::double)
    + least(len({s_words('text')}), 4) * 0.4::double
    + case when kind = 'properNoun' and regexp_matches(sentence, '\\bnamed\\s+' || text || '\\b') then 1.5::double else 0.0::double end
    + case when kind = 'properNoun' and contains(text, '-') then 0.8::double else 0.0::double end as score
from n
where length(text) >= 3
  and not (kind = 'properNoun' and (contains(text, '''s ')
    or regexp_replace(lower(string_split(text, ' ')[1]), '''s$', '') in {inlist(V.STOP_STARTS)}))
""".replace("\\\\b", "\\b").replace("\\\\s", "\\s"),
)

view(
    "v_emit",
    f"""
select doc_id, sent_idx, sentence, kind, pat, mat, text, score from v_found
union all
select doc_id, sent_idx, sentence, 'keyword', 6,
  unnest(range(len(regexp_extract_all(sentence, {lit(V.KEYWORD_RE)})))),
  unnest(regexp_extract_all(sentence, {lit(V.KEYWORD_RE)})), 2.0::double + 0.4::double
from v_sent where doc_id not in (select doc_id from v_found)
""",
)

view(
    "v_first",
    """
select * from v_emit
qualify row_number() over (partition by doc_id, lower(text) order by sent_idx, pat, mat) = 1
""",
)

view(
    "v_cand",
    f"""
select doc_id, text, sentence, sent_idx, score,
  case when kind = 'properNoun' and {s_looks_person('text', 'sentence')} then 'person' else kind end as kind,
  row_number() over (partition by doc_id order by score desc, sent_idx, pat, mat) - 1 as rank
from v_first
""",
)
