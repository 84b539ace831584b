"""Registered queries of the training-text operators, with the SQL they must agree with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arborsync.catalog import Catalog
from arborsync.llm import decontamination, jaccard_join, language_id, license_scan, line_templates, phrase_mining, prefix_trie, quality_classifier, quality_rules, sentencepiece_stream, sharding, token_counts, tool_calls

CATALOG = Catalog()


def tokenizer_file(name: str) -> str:
    """Where the installed public tokenizer files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(count: int) -> Column:
    """crc32 of the document id as text, modulo ``count``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % count


def _quality_sql() -> str:
    symbols = "".join(f"replace(" for _ in quality_rules.SYMBOLS) + "body" + "".join(f", '{c}', '')" for c in quality_rules.SYMBOLS)
    stops = ", ".join(f"'{w}'" for w in [*quality_rules.STOP_WORDS, *[w.capitalize() for w in quality_rules.STOP_WORDS]])
    rules = " and ".join(
        f"(n_words < {r.from_words} or ("
        + " and ".join([f"{r.metric} >= {r.low}"] * (r.low is not None) + [f"{r.metric} <= {r.high}"] * (r.high is not None))
        + "))"
        for r in quality_rules.RULES
    )
    return f"""
with d as (select row_number() over () as rid, *, coalesce(text, '') as body from documents),
 w as (select *, list_filter(string_split_regex(body, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words,
         list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as ls from d),
 g as (select rid, i, list_slice(words, i, i + 4) as gram
       from (select rid, words, unnest(range(1, greatest(len(words) - 3, 1))) as i from w)),
 twice as (select rid, i from (select rid, i, count(*) over (partition by rid, gram) as n from g) where n > 1),
 hit as (select rid, count(distinct i + k) as n_rep from twice, range(0, 5) as o(k) group by rid),
 m as (select doc_id, len(words) as n_words, length(regexp_replace(body, '[\\x20\\x09-\\x0D]+', '', 'g')) as word_chars,
         strlen(body) - strlen({symbols}) as n_symbols, len(ls) - len(list_distinct(ls)) as n_dup_lines,
         coalesce(n_rep, 0) as n_repeat_words, strlen(body) - strlen(replace(body, '!', '')) as exclaims, len(ls) as n_lines,
         len(list_filter(words, lambda x: x in ({stops}))) as stops
       from w left join hit using (rid)),
 r as (select *, case when n_words > 0 then n_repeat_words / n_words else 0 end as repeat_ratio,
         case when word_chars > 0 then n_symbols / word_chars else 0 end as symbol_ratio,
         case when word_chars > 0 then exclaims / word_chars else 0 end as exclaim_ratio,
         case when n_words > 0 then word_chars / n_words else 0 end as mean_word_chars,
         case when n_lines > 0 then n_dup_lines / n_lines else 0 end as dup_line_ratio,
         case when n_words > 0 then stops / n_words else 0 end as stop_ratio,
         n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  not base_failed and {rules} as kept from r"""


@CATALOG.query(_quality_sql())
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select("doc_id", *quality_rules.BASE, "base_failed", "kept")


@CATALOG.query()
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, tokenizer_file("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


_DECONTAMINATE_SQL = r"""
with low as (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' as up, 'abcdefghijklmnopqrstuvwxyz' as down),
 d as (select row_number() over () as rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), up, down), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents, low),
 b as (select item_id, regexp_extract_all(translate(text, up, down), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
       from benchmark, low where text is not null),
 b2 as (select item_id, words, least(len(words), 10) as m from b where len(words) > 0),
 p as (select distinct item_id, m, list_slice(words, i, i + m - 1) as gram
       from (select item_id, words, m, unnest(range(1, len(words) - m + 2)) as i from b2)),
 lengths as (select distinct m from p),
 g as (select rid, i, m, list_slice(words, i, i + m - 1) as gram
       from (select rid, words, m, unnest(range(1, greatest(len(words) - m + 2, 1))) as i from d, lengths)),
 o as (select rid, i, m, item_id from g join p using (m, gram)),
 hits as (select rid, count(distinct k) as n_hit from (select rid, unnest(range(i, i + m)) as k from o) group by rid),
 found as (select rid, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from o group by rid)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hits using (rid) left join found using (rid)"""


@CATALOG.query(_DECONTAMINATE_SQL)
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.find(docs, table(spark, folder, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["word_end"] - s["word_begin"])
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


_SIMILAR_SQL = r"""
with recursive d as (select doc_id, text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
 t as (select text, any_value(words) as words, min(doc_id) as id, count(*) as n_copies from d where len(words) > 0 group by text),
 g as (select distinct id, list_slice(words, i, i + 4) as gram from (select id, words, unnest(range(1, greatest(len(words) - 3, 2))) as i from t)),
 n as (select id, count(*) as n from g group by id),
 p as (select a.id as a, b.id as b, count(*) as k from g as a join g as b on a.gram = b.gram and a.id <> b.id group by all),
 l as (select a, b from p join n as x on x.id = a join n as y on y.id = b where 10 * k >= 8 * (x.n + y.n - k)),
 r as (select id as a, id as b from t union select r.a, l.b from r join l on l.a = r.b),
 c as (select a, min(b) as class_id from r group by a),
 m as (select a, count(*) as n_links from l group by a)
select d.doc_id, coalesce(c.class_id, d.doc_id) as class_id, coalesce(n_links, 0)::bigint as n_links, coalesce(n_copies, 1)::bigint as n_copies
from d left join t on t.text = d.text left join c on c.a = t.id left join m on m.a = t.id"""


@CATALOG.query(_SIMILAR_SQL)
def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return jaccard_join.similar_texts(docs).select("doc_id", "class_id", "n_links", "n_copies")


@CATALOG.query()
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    left = F.coalesce("_left", F.lit(""))
    return line_templates.drop_recurring(docs).select(
        "doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"),
        F.octet_length(left).cast("bigint").alias("bytes_left"), F.crc32(left.cast("binary")).alias("left_crc32"),
        ((F.col("_dropped") > 0) & ~left.rlike("[^\\x20\\x09-\\x0D]")).alias("emptied"),
    )


@CATALOG.query()
def op10_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    tokenizer = sentencepiece_stream.Tokenizer(spark, tokenizer_file("piece_bpe_32k.model"))
    encoded = docs.withColumn("ids", tokenizer.encode("text"))
    decoded = encoded.withColumn("decoded", tokenizer.decode("ids"))
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_pieces"), "ids",
        (F.col("decoded") == F.replace(F.coalesce("text", F.lit("")), F.lit("\u2581"), F.lit(" "))).alias("round_trip"),
    )


@CATALOG.query()
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    body = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(body) + 1).cast("bigint").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"))
    placed = sharding.assign_shards(docs, ["doc_id"], shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@CATALOG.query()
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang").withColumn("held_out", fold(3) == 1)
    model = language_id.fit(docs.where(~F.col("held_out")), "doc_id", "text", "lang")
    return language_id.predict(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score")


@CATALOG.query()
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality_classifier.score_quality(docs, table(spark, folder, "labels"), learn=fold(4) != 2)
    return scored.select(
        "doc_id", (fold(4) == 2).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


# Tools that the turns of a conversation are read as: a system turn instructs, a user turn asks.
TOOLS = {
    "ask": {
        "properties": {
            "question": {"type": "string", "minLength": 20, "maxLength": 350}, "turn": {"type": "integer", "minimum": 0},
            "words": {"type": "integer", "minimum": 3, "maximum": 60},
        },
        "required": ["question", "turn", "words"], "additionalProperties": False,
    },
    "instruct": {
        "properties": {"question": {"type": "string"}, "turn": {"type": "integer", "maximum": 0}},
        "required": ["question"], "additionalProperties": False,
    },
}

_TOOL_CALLS_SQL = """
with t as (select conv_id, turn, role, coalesce(text, '') as body, role <> 'assistant' as is_call,
    case when role = 'assistant' then turn - 1 else turn end as asked,
    len(list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0b\\f\\r]+'), lambda w: w <> '')) as words from conversations),
 named as (select *, concat(conv_id, '-', case when conv_id % 4 = 3 and asked % 4 in (2, 3) then asked - 2 else asked end) as id from t),
 placed as (select *, row_number() over (partition by is_call, id order by turn) = 1 as is_first from named),
 c as (select *, case when conv_id % 4 = 1 or conv_id % 4 = 2 and turn % 4 in (0, 1) then turn + 2
     when conv_id % 4 = 2 or conv_id % 4 = 0 and turn >= 2 then turn - 2 end as needed from placed where is_call),
 r as (select * from placed where not is_call),
 known as (select c.*, n.id is not null as has_need, r.id is not null as answered
   from c left join c as n on n.conv_id = c.conv_id and n.turn = c.needed left join r on r.id = c.id and r.is_first),
 runs as (select *, turn + 2 * row_number() over (partition by conv_id, turn % 2 order by turn desc) as run from known),
 ranked as (select *, conv_id % 4 = 2 and has_need as cyclic,
     case when conv_id % 4 = 1 then row_number() over (partition by conv_id, turn % 2, run order by turn desc) else 0 end as level from runs),
 steps as (select id, row_number() over (partition by conv_id order by cyclic, level, turn) as step from ranked where is_first),
 calls as (select ranked.*, case when is_first then step end as step from ranked join steps using (id)),
 judged as (select *, list_sort(list_filter(case when role = 'user' then
       [case when length(body) < 20 then 'question: minLength' end, case when length(body) > 350 then 'question: maxLength' end,
        case when words < 3 then 'words: minimum' end, case when words > 60 then 'words: maximum' end]
     else ['words: not allowed', case when turn > 0 then 'turn: maximum' end] end, lambda e: e is not null)) as found,
     case when is_first and needed is not null and not has_need then [concat('needs ', conv_id, '-', needed, ': missing')] else [] end as absent,
     case when is_first and cyclic then ['needs: cyclic'] else [] end as circle from calls)
select conv_id, turn, 'call' as kind, id, case when not is_first then 'duplicate' when answered then 'linked' else 'unanswered' end as status, step,
  array_to_string(list_concat(list_concat(found, absent), circle), '; ') as errors, len(found) + len(absent) + len(circle) as n_errors,
  concat('{"arguments":{"question":', to_json(body)::varchar, ',"turn":', turn, ',"words":', words, '},"id":"', id, '","kind":"call","needs":',
    case when needed is not null then concat('["', conv_id, '-', needed, '"]') else '[]' end, ',"tool":"', case when role = 'user' then 'ask' else 'instruct' end, '"}') as json
from judged
union all
select r.conv_id, r.turn, 'result', r.id, case when not r.is_first then 'duplicate' when calls.id is not null then 'linked' else 'orphan' end,
  case when r.is_first then calls.step end, '', 0, concat('{"content":', to_json(r.body)::varchar, ',"id":"', r.id, '","kind":"result"}')
from r left join calls on calls.id = r.id and calls.is_first"""


@CATALOG.query(_TOOL_CALLS_SQL)
def op4_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as tool use: a turn that is not the assistant's is a call, an assistant's turn the result
    of the turn before. By conv_id % 4 calls need the call two turns before, the one two turns later, each
    other in pairs, or nothing but share their ids in pairs."""
    turns = table(spark, folder, "conversations")
    body = F.coalesce("text", F.lit(""))
    turn, group = F.col("turn"), F.col("conv_id") % 4
    name = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    known_as = lambda turn: name(F.when((group == 3) & (turn % 4).isin(2, 3), turn - 2).otherwise(turn))
    trimmed = F.btrim(body, F.lit(quality_rules.SPACES))
    words = F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, quality_rules.SPACE_RUN)))
    is_result = F.coalesce(F.col("role") == "assistant", F.lit(False))
    later = (group == 1) | ((group == 2) & (turn % 4).isin(0, 1))
    earlier = (group == 2) | ((group == 0) & (turn >= 2))
    needs = F.when(later, F.array(name(turn + 2))).when(earlier, F.array(name(turn - 2))).otherwise(F.array().cast("array<string>"))
    calls = turns.where(~is_result).select(
        F.col("conv_id").alias("conversation"), known_as(turn).alias("id"), turn.alias("position"),
        F.when(F.col("role") == "user", "ask").otherwise("instruct").alias("tool"),
        F.to_json(F.struct(words.alias("words"), turn, body.alias("question"))).alias("arguments"), needs.alias("needs"),
    )
    results = turns.where(is_result).select(
        F.col("conv_id").alias("conversation"), known_as(turn - 1).alias("id"), turn.alias("position"), body.alias("content"))
    linked = tool_calls.link_calls(calls, results, TOOLS)
    return linked.select(
        F.col("conversation").alias("conv_id"), F.col("position").alias("turn"), "kind", "id", "status", "step",
        F.concat_ws("; ", "errors").alias("errors"), "n_errors", "json")


_PHRASES_SQL = r"""
with low as (select 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' as up, 'abcdefghijklmnopqrstuvwxyz' as down),
 p as (select coalesce(lang, 'und') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), up, down), '[.,;:!?\x0A-\x0D]')) as piece from documents, low),
 w as (select row_number() over () as pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from p),
 t as (select lang, sum(len(words))::hugeint as n from w group by lang),
 g as (select lang, array_to_string(list_slice(words, i, i + k - 1), ' ') as phrase, k
       from (select lang, words, k, unnest(range(1, greatest(len(words) - k + 2, 1))) as i from w, range(1, 6) as o(k))),
 f as (select lang, phrase, any_value(k) as k, count(*)::hugeint as f from g group by lang, phrase having count(*) >= 100),
 c as (select lang, phrase, k, f as a, string_split(phrase, ' ') as words from f where k > 1),
 cuts as (select c.*, j, array_to_string(list_slice(words, 1, j), ' ') as front, array_to_string(list_slice(words, j + 1, k), ' ') as back
       from (select *, unnest(range(1, k)) as j from c) as c),
 scored as (select cuts.lang, cuts.phrase, a, l.f as l, r.f as r, n, j, (1000 * a * n) // (l.f * r.f) as score
       from cuts join f as l on l.lang = cuts.lang and l.phrase = front join f as r on r.lang = cuts.lang and r.phrase = back
         join t on t.lang = cuts.lang),
 best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, j) = 1),
 inner_of as (select lang, a as longer, array_to_string(list_slice(words, i, i + m - 1), ' ') as phrase
       from (select *, unnest(range(1, k - m + 2)) as i from (select *, unnest(range(2, k)) as m from c))),
 gone as (select distinct best.lang, best.phrase from best join inner_of using (lang, phrase) where 100 * longer >= 100 * a),
 ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank
       from best anti join gone using (lang, phrase))
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked where rank <= 2000"""


@CATALOG.query(_PHRASES_SQL)
def op12_phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    return phrase_mining.mine_phrases(docs, id="doc_id")


def _license_sql() -> str:
    words = [license_scan.split_license_words(text) for _, text in license_scan.TEMPLATES]
    grams = [
        (i, label, len(own), at, own[at : at + 3])
        for i, ((label, _), own) in enumerate(zip(license_scan.TEMPLATES, words)) for at in range(len(own) - 2)
    ]
    places = ", ".join(f"({i}, '{label}', {width}, {at}, '{g[0]}', '{g[1]}', '{g[2]}')" for i, label, width, at, g in grams)
    stands = " or ".join(
        "(" + " and ".join(f"{c} = '{w}'" for c, w in zip("abc", phrase.split(" "))) + f" and base = '{label}')"
        for phrase, label in license_scan.PHRASES.items())
    bases = ", ".join(f"('{label}')" for label in license_scan.PHRASES.values())
    return rf"""
with low as (select '{license_scan.UPPER}' as up, '{license_scan.UPPER.lower()}' as down),
 d as (select row_number() over () as rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), up, down), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents, low),
 w as (select rid, i - 1 as i, words[i] as a, words[i + 1] as b, words[i + 2] as c
       from (select rid, words, unnest(range(1, len(words) + 1)) as i from d)),
 base as (select rid, i, base from w, (values {bases}) as v(base) where {stands}),
 b as (select rid, count(*) as n_base, min(i) as first_word, max(i) as last_word from base group by rid),
 t0 as (select * from (values {places}) as v(template, label, width, place, a, b, c)),
 own as (select a, b, c from t0 group by a, b, c having count(distinct label) = 1),
 t as (select t0.*, own.a is not null as own from t0 left join own using (a, b, c)),
 sizes as (select template, count(*) as n_places, count(*) filter (own) as n_own from t group by template),
 m as (select rid, template, label, width, i - place as diagonal, place, own from w join t using (a, b, c)),
 v as (select distinct rid, template, label, width, diagonal from m),
 n as (select *, sum(apart) over (partition by rid, template order by diagonal) as notice from
       (select *, case when diagonal - lag(diagonal) over (partition by rid, template order by diagonal) > floor(width * 0.25) then 1 else 0 end as apart from v)),
 s as (select rid, template, label, notice, count(distinct place) / any_value(n_places) as share,
         count(distinct place) / any_value(n_places) >= 0.6 and any_value(n_own) > 0
           and count(distinct place) filter (own) >= 0.6 * any_value(n_own) as verified
       from m join n using (rid, template, label, width, diagonal) join sizes using (template) group by all),
 best as (select rid, max(share) as share from s group by rid),
 named as (select rid, base as label, true as is_base from base union select rid, label, false from s where verified),
 l as (select rid, string_agg(distinct label, ',' order by label) as labels,
         string_agg(distinct label, ',' order by label) filter (is_base) as base_labels from named group by rid)
select doc_id, len(words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
  last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  case when n_base > 0 then 1.0 else coalesce(share, 0) end::double as score
from d left join b using (rid) left join best using (rid) left join l using (rid)"""


@CATALOG.query(_license_sql())
def op13_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return license_scan.find_licenses(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


_TRIE_SQL = """
with turns as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null),
 t as (select conv_id, list({'role': role, 'text': text} order by turn nulls first, md5(concat(strlen(role), ':', role, text))) as own
       from turns group by conv_id),
 h as (select conv_id, own, conv_id - conv_id % 5 as source, (xor(list_reduce(
           list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
           lambda a, x: list_reduce(list_prepend(xor(a, x), range(8)), lambda p, i: case when p % 2 = 1 then xor(p // 2, 3988292384) else p // 2 end)
         ), 4294967295) % 9)::bigint as head from t),
 r as (select h.conv_id, list_concat(coalesce(list_slice(b.own, 1, head), []), list_slice(h.own, head + 1, len(h.own))) as turns
       from h left join t as b on b.conv_id = h.source),
 p as (select conv_id, d, len(turns) = d as ends_here, list_slice(turns, 1, d) as key, turns[d].text as last
       from (select *, unnest(range(0, len(turns) + 1)) as d from r)),
 n as (select key, any_value(last) as last, d as depth, min(conv_id) as conv_id, count(*) as n_convs,
         coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends_here), '') as ends from p group by key, d),
 c as (select list_slice(key, 1, depth - 1) as key, count(*) as n_children from n where depth > 0 group by 1),
 m as (select n.*, coalesce(n_children, 0) as n_children from n left join c on c.key = n.key),
 below as (select a.key, count(*) filter (b.n_children = 0) as n_leaves, sum((b.n_convs - 1) * coalesce(strlen(b.last), 0)) as saved
       from m as a join m as b on b.depth >= a.depth and list_slice(b.key, 1, a.depth) = a.key group by a.key)
select m.conv_id, m.depth::bigint as depth, up.conv_id as parent_conv_id, m.n_convs::bigint as n_convs, m.n_children::bigint as n_children,
  n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, sha256(m.ends) as ends_sha256
from m join below on below.key = m.key left join m as up on m.depth > 0 and up.key = list_slice(m.key, 1, m.depth - 1)"""


@CATALOG.query(_TRIE_SQL)
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations rebuilt to share beginnings: up to eight first turns come from the first of each five."""
    turns = prefix_trie.hashed_turns(table(spark, folder, "conversations"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    shared = prefix_trie.rebuilt(turns, head, F.col("conv_id") - F.col("conv_id") % 5, most=8)
    return prefix_trie.prefix_trie(shared, turns.select("conv_id"))
