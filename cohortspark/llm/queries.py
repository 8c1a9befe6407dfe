"""The registered queries of this subpackage: each applies one operator to its whole table and derives the digest
columns; ``sql`` is the same in DuckDB where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortspark.llm import chat, exact, fingerprints, language, licences, ngrams, packing, pieces, quality, repair
from cohortspark.llm import secrets, substrings, tries
from cohortspark.llm.common import Scratch, kept, query, table

_EXACT = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents),
w AS (SELECT doc_id, h, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
        row_number() OVER (PARTITION BY h ORDER BY doc_id) AS r FROM n)
SELECT doc_id, keep_id, group_size, r = 1 AS kept, h AS text_sha256 FROM w
"""


@query("op2_exact_dedup", _EXACT)
def op2_exact_dedup(spark, d):
    return exact.exact_groups(table(spark, d, "documents"))


_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text,
    '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '[SYS]', '[\SYS]'),
    '[/SYS]', '[\/SYS]'), '[ROLE]', '[\ROLE]'), '[/ROLE]', '[\/ROLE]'), '[END]', '[\END]') AS esc FROM rows),
f AS (SELECT *, CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 14 ELSE 8 END + length(esc) AS chars FROM e)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  list_last(list(role ORDER BY turn, role, text)) = 'assistant'
    AND regexp_full_match(string_agg(role, ' ' ORDER BY turn, role, text), '(system )?user assistant( user assistant)*') AS valid
FROM f GROUP BY conv_id
"""


@query("op6_chat_formatting", _CHAT)
def op6_chat_formatting(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(odd).alias("text"),
    )
    made = chat.format_conversations(rows.unionByName(extra))
    back = made.select(
        "conv_id",
        "valid",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "valid",
    )


def _licence_sql() -> str:
    """The same scan in SQL, with the templates as values."""
    grams = [(i, name, licences.template_bigrams(text)) for i, (name, text) in enumerate(licences.STANDARD)]
    values = ", ".join(f"({i}, '{name}', '{g}')" for i, name, gs in grams for g in gs)
    texts = [(i, text) for i, (_, text) in enumerate(licences.STANDARD)]
    begun = ", ".join(f"({i}, '{licences.opening(t)}', {len(licences.plain_words(t))})" for i, t in texts)
    return rf"""
WITH t(template, licence, gram) AS (VALUES {values}),
size AS (SELECT template, licence, count(*) AS b FROM t GROUP BY ALL),
lines AS (SELECT doc_id, 'line' AS kind, unnest(string_split(text, chr(10))) AS body,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS number FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, text, regexp_split_to_array(text, '
[ 	
]*
') AS ps FROM documents WHERE text IS NOT NULL),
paragraphs AS (SELECT doc_id, 'paragraph' AS kind, unnest(ps) AS body, generate_subscripts(ps, 1) - 1 AS number FROM p),
units AS (SELECT * FROM lines UNION ALL SELECT * FROM paragraphs WHERE contains(body, chr(10))
    UNION ALL SELECT doc_id, 'document', text, 0 FROM p WHERE len(ps) > 1),
words AS (SELECT doc_id, kind, number, list_filter(string_split(regexp_replace(
    lower(body), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM units),
grams AS (SELECT doc_id, kind, number, list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) AS g
    FROM words WHERE len(w) > 1),
each AS (SELECT doc_id, kind, number, len(g) AS a, unnest(g) AS gram FROM grams),
common AS (SELECT doc_id, kind, number, a, template, licence, count(*) AS c FROM each JOIN t USING (gram) GROUP BY ALL),
begun(template, pair, n) AS (VALUES {begun}),
text_words AS (SELECT doc_id, list_filter(string_split(regexp_replace(
    lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
places AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 1)) AS i FROM text_words WHERE len(w) > 1),
passages AS (SELECT doc_id, i - 1 AS number, template, list_slice(w, i, i + n - 1) AS w
    FROM places JOIN begun ON pair = w[i] || ' ' || w[i + 1]),
passage_grams AS (SELECT doc_id, number, template, list_distinct(list_transform(generate_series(1, len(w) - 1),
    lambda i: w[i] || ' ' || w[i + 1])) AS g FROM passages),
passage_each AS (SELECT doc_id, number, template, len(g) AS a, unnest(g) AS gram FROM passage_grams),
passage_common AS (SELECT doc_id, 'passage' AS kind, number, a, template, licence, count(*) AS c
    FROM passage_each JOIN t USING (template, gram) GROUP BY ALL),
every AS (SELECT * FROM common UNION ALL BY NAME SELECT * FROM passage_common),
scored AS (SELECT doc_id, kind, number, licence, template, 2.0 * c / (a + b) AS dice FROM every JOIN size USING (template, licence)
    WHERE 2.0 * c / (a + b) >= {licences.THRESHOLD}),
best AS (SELECT *, row_number() OVER (PARTITION BY doc_id, kind, number ORDER BY dice DESC, template) AS r FROM scored)
SELECT doc_id, kind, number, licence, template, round(dice, 6) AS dice FROM best WHERE r = 1
"""


@query("op4_license_scans", _licence_sql())
def op4_license_scans(spark, d):
    return licences.scan_licences(table(spark, d, "documents"))


@query("op8_secret_scans")
def op8_secret_scans(spark, d):
    kinds = secrets.KINDS
    base = [i for i, k in enumerate(kinds) if k.base]
    out = secrets.scan_secrets(table(spark, d, "documents"))

    def joined(spans):
        names = F.array(*[F.lit(k.name) for k in kinds])
        one = F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"]))
        return F.array_join(one, ",")

    def of_kind(i):
        return lambda s: s["kind"] == i

    def count(keep):
        return F.size(F.filter("found", keep)).cast("bigint")

    return out.select(
        "doc_id",
        *[count(of_kind(i)).alias(f"n_{kinds[i].name}") for i in base],
        F.sha2(joined(F.filter("found", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_examples"),
    )


@query("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark, d):
    return fingerprints.near_duplicate_groups(table(spark, d, "documents"))


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark, d):
    return packing.pack_documents(table(spark, d, "documents"), with_text=False).select(
        "bin_group",
        "bin_number",
        "capacity",
        "used",
        F.size("pieces").alias("n_pieces"),
        F.col("pieces.doc_id").alias("doc_ids"),
        F.col("pieces.start").alias("starts"),
        F.col("pieces.n_tokens").alias("n_tokens"),
    )


@query("op7_quality_rules")
def op7_quality_rules(spark, d):
    docs = table(spark, d, "documents")
    field = quality.train_field(docs, table(spark, d, "labels"))
    return quality.judge(docs, field).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_lines",
        "content_lines",
        F.round("content_share", 6).alias("content_share"),
    )


@query("op10_lm_scoring")
def op10_lm_scoring(spark, d):
    return ngrams.score_texts(table(spark, d, "documents"))


@query("op1_suffix_array_dedup")
def op1_suffix_array_dedup(spark, d):
    length = F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)")
    with Scratch(spark) as scratch:
        cleaned = substrings.remove_repeats(table(spark, d, "documents"), scratch)
        return kept(
            cleaned.select(
                "doc_id",
                "n_bytes",
                length.alias("n_removed"),
                F.size("spans").cast("bigint").alias("n_spans"),
                F.sha2("kept", 256).alias("kept_sha256"),
            )
        )


PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@query("op9_sentencepiece")
def op9_sentencepiece(spark, d):
    made = pieces.encode_texts(table(spark, d, "documents"), PIECE_MODEL)
    return made.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_ids"),
        F.round("score", 6).alias("score"),
        F.transform("alternatives", lambda a: F.round(a["score"], 6)).alias("other_scores"),
        F.transform("alternatives", lambda a: a["patches"]).alias("other_patches"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.col("whole").alias("round_trip"),
    )


def _crc32_sql(text: str) -> str:
    """crc32 of an ASCII text, bit by bit."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    bits = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x // 2, (x % 2) * 3988292384))"
    return f"xor(list_reduce({codes}, lambda a, b: {bits}, 4294967295::BIGINT), 4294967295)"


def _language_sql() -> str:
    """The same counts and scores in SQL."""
    word = r"'\p{L}[\p{L}\p{M}]*'"
    pieces = " UNION ALL ".join(
        [f"SELECT lang, {n} AS kind, unnest({_grams_sql('w', n)}) AS e, n FROM wc" for n in language.LENGTHS]
    )
    backoff = " UNION ALL ".join(f"SELECT w, {n} AS kind, unnest({_grams_sql('w', n)}) AS e FROM unseen" for n in language.LENGTHS)
    unit = language.UNIT
    return rf"""
WITH d AS (SELECT doc_id, lang, text, {_crc32_sql("doc_id::VARCHAR")} % 4 = 2 AS held_out FROM documents),
tokens AS (SELECT doc_id, held_out, lang, unnest(regexp_extract_all(lower(text), {word})) AS w FROM d),
wc AS (SELECT lang, w, count(*) AS n FROM tokens WHERE NOT held_out AND lang IS NOT NULL GROUP BY ALL),
pieces AS ({pieces}),
counts AS (SELECT lang, 0 AS kind, w AS e, n FROM wc UNION ALL SELECT lang, kind, e, sum(n)::BIGINT FROM pieces GROUP BY ALL),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang) AS g, count(*) OVER () AS many FROM (SELECT DISTINCT lang FROM wc)),
sizes AS (SELECT kind, lang, n, count(*) AS size FROM counts GROUP BY ALL),
sums AS (SELECT kind, lang, n, sum(size) OVER (PARTITION BY kind, lang ORDER BY n DESC) AS size FROM sizes),
least AS (SELECT kind, lang, min(n) AS least FROM sums JOIN langs USING (lang) WHERE size <= {language.MODEL_ENTRIES} // many GROUP BY ALL),
totals AS (SELECT kind, lang, sum(n) AS total FROM counts GROUP BY ALL),
model AS (SELECT kind, lang, e, greatest(1, round({unit} * ({language.PENALTY} + log10(n / total))))::BIGINT AS gain
    FROM counts JOIN least USING (kind, lang) JOIN totals USING (kind, lang) WHERE n >= least),
per AS (SELECT doc_id, w, count(*) AS n FROM tokens GROUP BY ALL),
unseen AS (SELECT DISTINCT w FROM per WHERE w NOT IN (SELECT e FROM model WHERE kind = 0)),
tried AS ({backoff}),
found AS (SELECT w, kind, count(*) AS many FROM tried WHERE (kind, e) IN (SELECT kind, e FROM model) GROUP BY ALL),
longest AS (SELECT w, max(kind) AS kind, max_by(many, kind) AS many FROM found GROUP BY w),
gains AS (SELECT e AS w, lang, gain FROM model WHERE kind = 0
    UNION ALL SELECT w, lang, sum(gain)::BIGINT // any_value(many) FROM longest JOIN tried USING (w, kind) JOIN model USING (kind, e) GROUP BY w, lang),
known AS (SELECT DISTINCT w FROM gains),
counted AS (SELECT doc_id, sum(n) FILTER (w IN (SELECT w FROM known)) AS counted FROM per GROUP BY doc_id),
sum_of AS (SELECT doc_id, lang, sum(n * gain) AS s FROM per JOIN gains USING (w) GROUP BY ALL),
scored AS (SELECT doc_id, lang, g, many, coalesce(counted, 0) AS counted, coalesce(s, 0) AS s
    FROM counted CROSS JOIN langs LEFT JOIN sum_of USING (doc_id, lang)),
common AS (SELECT lang FROM wc GROUP BY lang ORDER BY sum(n) DESC, lang LIMIT 1),
best AS (SELECT doc_id, max(s) AS top, any_value(counted) AS counted, any_value(many) AS many, arg_min(lang, (-s, g)) AS lang FROM scored GROUP BY doc_id),
share AS (SELECT doc_id, sum(pow(10.0, (s - top) / ({unit} * best.counted))) AS total FROM scored JOIN best USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, held_out,
    CASE WHEN best.doc_id IS NULL THEN 'und' WHEN counted = 0 THEN (SELECT lang FROM common) ELSE best.lang END AS lang_pred,
    round(CASE WHEN best.doc_id IS NULL THEN 0.0 WHEN counted = 0 THEN 1 / many ELSE 1 / total END, 6) AS score
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN share USING (doc_id)
"""


def _grams_sql(word: str, n: int) -> str:
    if n == 1:
        return f"string_split({word}, '')"
    padded = f"(' ' || {word} || ' ')"
    return f"list_transform(range(1, length({word}) + {4 - n}), lambda i: substr({padded}, i, {n}))"


@query("op11_language_id", _language_sql())
def op11_language_id(spark, d):
    docs = table(spark, d, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    held_out = F.coalesce(remainder == 2, F.lit(False))
    model = language.fit(docs.filter(~held_out))
    out = language.identify(docs, model, "doc_id", "text", held_out.alias("held_out"))
    return out.withColumn("score", F.round("score", 6))


_TRIE = rf"""
WITH h AS (SELECT conv_id, {_crc32_sql("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
own AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, ''))
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns FROM conversations GROUP BY conv_id),
s AS (SELECT h.conv_id, list_concat(coalesce(b.turns, [])[1:h], o.turns[h + 1:]) AS s
    FROM h JOIN own o USING (conv_id) LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 20),
pre AS (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS depth FROM s),
nodes AS (SELECT s[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len(s)), '')) AS ends_sha256
    FROM pre GROUP BY 1, 2),
w AS (SELECT *, CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(node[depth].x, '[^ 	-
]+')) END AS words FROM nodes),
kids AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
n AS (SELECT w.*, coalesce(n_children, 0) AS n_children FROM w LEFT JOIN kids USING (node)),
below AS (SELECT a.node, sum((b.n_children = 0)::INT) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved_tokens
    FROM n a JOIN n b ON b.depth >= a.depth AND b.node[1:a.depth] = a.node GROUP BY a.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves::BIGINT AS n_leaves,
    saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN below USING (node) LEFT JOIN n p ON n.depth > 0 AND p.node = n.node[1:n.depth - 1] AND p.depth = n.depth - 1
"""


def shared_heads(symbols, members):
    """Conversations rebuilt to share their beginnings: the first h turns of conversation c - c % 20, then c's own turns
    after its first h, where h = crc32(c) % 4."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    base = F.col("conv_id") - F.col("conv_id") % 20
    heads = symbols.filter((F.col("conv_id") % 20 == 0) & (F.col("pos") < 3)).withColumnRenamed("conv_id", "base")
    sizes = heads.groupBy("base").agg(F.count(F.lit(1)).alias("size"))
    put = members.select("conv_id", base.alias("base"), h.alias("h")).join(heads, "base").filter("pos < h")
    shift = F.least("h", F.coalesce("size", F.lit(0))) - F.col("h")
    own = symbols.withColumns({"base": base, "h": h}).filter("pos >= h").join(sizes, "base", "left").withColumn("pos", F.col("pos") + shift)
    columns = ["conv_id", F.col("pos").cast("bigint").alias("pos"), "symbol", "words"]
    return put.select(*columns).unionByName(own.select(*columns))


@query("op12_prefix_trie", _TRIE)
def op12_prefix_trie(spark, d):
    rows = table(spark, d, "conversations")
    with Scratch(spark) as scratch:
        members = scratch.table(rows.filter("conv_id is not null").select("conv_id").distinct())
        symbols = scratch.table(tries.turn_symbols(rows))
        symbols = scratch.table(shared_heads(symbols, members))
        trie = tries.prefix_trie(symbols, members, scratch)
        return kept(
            trie.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
        )


def _repair_sql() -> str:
    """The same damage, faults and edits in SQL; the edits by a recursion over (cost, audit) pairs."""

    def put(letter: str, cost: int | str, x: str) -> str:
        return f"{{'c': {x}.c + {cost}, 'a': '{letter}' || {x}.a}}"

    def least(*xs: str) -> str:
        return f"list_sort([{', '.join(xs)}])[1]"

    def row(q: str, initial: str | None, kept: str | None, changed: str) -> str:
        keep = f"CASE WHEN stays AND i = '{initial}' THEN {put('K', 'extra', kept)} END" if initial else None
        change = f"CASE WHEN stays THEN {put('R', '3 + extra', changed)} END"
        return f"list_sort(list_filter([{', '.join(x for x in (put('D', 4, q), keep, change) if x)}], lambda x: x IS NOT NULL))[1]"

    crc = _crc32_sql("k")
    return rf"""
WITH RECURSIVE told AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
hit AS (SELECT *, {crc} % 20 AS kind FROM told),
changed AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, kind FROM hit WHERE kind <> 0),
twice AS (SELECT conv_id, turn, role, text FROM changed UNION ALL SELECT conv_id, turn, role, text FROM changed WHERE kind = 3),
rows AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
    count(*) OVER (PARTITION BY conv_id) AS size FROM twice),
marked AS (SELECT *, left(role, 1) AS i, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before,
    CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
        WHEN regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault FROM rows),
coded AS (SELECT conv_id, size - n + 1 AS k, i, fault IN ('fine', 'truncated') AS stays,
    CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra FROM marked),
best AS (SELECT DISTINCT conv_id, 0::BIGINT AS k, {{'c': 0, 'a': ''}} AS q, {{'c': 6, 'a': 'II'}} AS s, {{'c': 3, 'a': 'I'}} AS u, {{'c': 0, 'a': ''}} AS a FROM conversations
    UNION ALL SELECT conv_id, k, {least('q', put('I', 3, 'w'))}, {least('s', put('I', 3, 'w'))}, w, {least('a', put('I', 3, 'u'))} FROM (
        SELECT *, {least('u', put('I', 3, 'a'))} AS w FROM (
            SELECT b.conv_id, c.k, {least("list_sort(list_filter([" + put('D', 4, 'b.q') + ", CASE WHEN stays AND i = 's' THEN " + put('K', 'extra', 'b.s') + " END, CASE WHEN stays AND i = 'u' THEN " + put('K', 'extra', 'b.u') + " END, CASE WHEN stays THEN " + put('R', '3 + extra', 'b.u') + " END], lambda x: x IS NOT NULL))[1]")} AS q,
                {row('b.s', 'u', 'b.u', 'b.u')} AS s, {row('b.u', 'a', 'b.a', 'b.a')} AS u, {row('b.a', 'u', 'b.u', 'b.u')} AS a
            FROM best b JOIN coded c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.k = b.k + 1))),
done AS (SELECT conv_id, max_by(q, k) AS w FROM best GROUP BY conv_id),
held AS (SELECT conv_id, list({{'r': role, 't': text}} ORDER BY n) AS rows FROM rows GROUP BY conv_id),
walk AS (SELECT d.conv_id, w.a AS audit, rows, 0 AS p, 0 AS used, '' AS last, []::VARCHAR[] AS out FROM done d LEFT JOIN held h ON h.conv_id IS NOT DISTINCT FROM d.conv_id
    UNION ALL SELECT conv_id, audit, rows, p + 1, used + (e <> 'I')::INT, CASE WHEN e = 'D' THEN last ELSE left(r, 1) END,
        CASE WHEN e = 'D' THEN out ELSE list_append(out, r || ':' || t) END FROM (
        SELECT *, CASE WHEN e = 'K' THEN rows[used + 1].r WHEN last = 'u' THEN 'assistant' ELSE 'user' END AS r,
            CASE WHEN e = 'I' THEN '' ELSE rows[used + 1].t END AS t FROM (SELECT *, substr(audit, p + 1, 1) AS e FROM walk WHERE p < length(audit)))),
texts AS (SELECT conv_id, sha256(array_to_string(max_by(out, p), chr(10))) AS repaired_sha256 FROM walk GROUP BY conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, w.c::BIGINT AS cost, w.a AS audit, repaired_sha256
FROM done d JOIN texts t ON t.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
"""


@query("op13_conversation_repair", _repair_sql())
def op13_conversation_repair(spark, d):
    rows = table(spark, d, "conversations")
    made = repair.repair_conversations(repair.damaged(rows), rows.select("conv_id").distinct())
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return made.withColumn("repaired_sha256", F.sha2(F.array_join(lines, "\n"), 256)).drop("turns")
