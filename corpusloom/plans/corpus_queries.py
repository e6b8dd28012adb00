"""Queries of text features, gates, deduplication and lookups over the corpus tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions import udfs as U
from corpusloom.functions import wordlists as W
from corpusloom.operators import dedup as D
from corpusloom.operators import gates as G
from corpusloom.operators import joins as J
from corpusloom.plans import sqlparts as S
from corpusloom.plans.registry import query

c = F.col


def filled(name):
    return F.coalesce(c(name), F.lit(""))


def TXT():
    return filled("text")


def RSP():
    return filled("response")


def INS():
    return filled("instruction")


r6 = lambda x: F.round(x, 6)

# ---- scalar features


@query("f01_script_shares", f"SELECT doc_id, round({S.f1('t')}, 6) f1, round({S.f2('t')}, 6) f2, round({S.f3('t')}, 6) f3, round({S.f4('t')}, 6) f4 FROM (SELECT doc_id, coalesce(text, '') t FROM documents)")
def _(t):
    return t.documents.select("doc_id", r6(X.script_share_of_text(TXT())).alias("f1"), r6(X.script_share_of_letters(TXT())).alias("f2"), r6(X.script_share_of_marked(TXT())).alias("f3"), r6(X.latin_share(TXT())).alias("f4"))


@query("f05_word_counts", f"SELECT doc_id, {S.n_words('t')}::bigint n_words, len(regexp_extract_all(t, {S.q(chr(91) + 'A-Za-z' + S.DEV + chr(39) + ']+')}))::bigint n_tokens FROM (SELECT doc_id, coalesce(text, '') t FROM documents)")
def _(t):
    return t.documents.select("doc_id", X.word_count(TXT()).cast("long").alias("n_words"), X.token_word_count(TXT()).cast("long").alias("n_tokens"))


@query("f07_content_words", f"SELECT row_id, len(list_distinct(list_transform(regexp_extract_all(coalesce(response, ''), '[{S.DEV}]{{3,}}|[a-zA-Z]{{4,}}'), lambda x: lower(x))))::bigint n_content FROM train_smoke")
def _(t):
    return t.train_smoke.select("row_id", F.size(X.content_words(RSP())).cast("long").alias("n_content"))


@query("f08_trigram_uniqueness", f"SELECT row_id, round({S.unique('w')}, 6) uniqueness FROM (SELECT row_id, {S.words(S.text('response'))} w FROM train_smoke)")
def _(t):
    return t.train_smoke.select("row_id", X.words(RSP()).alias("w")).select("row_id", r6(X.trigram_uniqueness(c("w"))).alias("uniqueness"))


@query(
    "f09_hash_keys",
    "SELECT pool_id, sha1(left(instruction, 200))[:16] k1, sha1(coalesce(plang, '') || '|' || instruction)[:16] k2, sha1(lower(instruction))[:16] k3, sha256(instruction) h FROM pool_todo WHERE instruction IS NOT NULL",
)
def _(t):
    i = c("instruction")
    p = t.pool_todo.where(i.isNotNull())
    return p.select("pool_id", X.sha1_key(F.left(i, F.lit(200))).alias("k1"), X.sha1_key(F.concat(F.coalesce("plang", F.lit("")), F.lit("|"), i)).alias("k2"), X.sha1_key(F.lower(i)).alias("k3"), X.content_hash(i).alias("h"))


@query("f11_nfc_keys", "SELECT doc_id, sha1(nfc_normalize(text))[:20] k FROM documents WHERE text IS NOT NULL")
def _(t):
    return t.documents.where("text is not null").select("doc_id", X.sha1_key(U.nfc("text"), 20).alias("k"))


@query("f12_percent_decoded")
def _(t):
    return t.documents.where(c("text").contains("http")).select("doc_id", U.percent_decoded(F.regexp_replace("text", " ", "%2520")).alias("decoded"))


@query("f13_list_marks", r"""SELECT pool_id, regexp_replace(regexp_replace(coalesce(instruction, ''), '^[\s\-*•\p{Nd}.)]+', ''), '^["''“”]+|["''“”]+$', '', 'g') cleaned FROM pool_todo""")
def _(t):
    return t.pool_todo.select("pool_id", X.strip_list_mark(INS()).alias("cleaned"))


@query("f14_token_estimates", "SELECT doc_id, ceil(strlen(text) / 3.2)::bigint prose, ceil(strlen(text) / 2.8)::bigint json FROM documents WHERE text IS NOT NULL")
def _(t):
    return t.documents.where("text is not null").select("doc_id", X.prose_tokens(c("text")).alias("prose"), X.prose_tokens(c("text"), 2.8).alias("json"))


@query("f16_message_tokens", "SELECT key, sum(4 + CASE WHEN m.content IS NULL THEN 0 ELSE ceil(strlen(m.content) / 3.2) END)::bigint tokens FROM (SELECT key, unnest(messages) m FROM oasst_v8) GROUP BY key")
def _(t):
    total = F.aggregate(F.transform("messages", lambda m: X.message_tokens(m.role, m.content)), F.lit(0).cast("long"), lambda a, x: a + x)
    return t.oasst_v8.where(F.size("messages") > 0).select("key", total.alias("tokens"))


@query("f17_byte_prefix")
def _(t):
    return t.documents.where("text is not null").select("doc_id", U.utf8_prefix(80)("text").alias("prefix"))


@query("f18_previews", r"SELECT row_id, CASE WHEN length(l) > 80 THEN left(l, 80) || '...' ELSE l END preview FROM (SELECT row_id, regexp_replace(coalesce(response, ''), '[ \t\n\x{0B}\f\r]+', ' ', 'g') l FROM train_smoke)")
def _(t):
    return t.train_smoke.select("row_id", X.preview(RSP(), 80).alias("preview"))


@query("f20_chat_render", "SELECT key, md5(coalesce(string_agg('<|im_start|>' || m.role || chr(10) || coalesce(m.content, '') || '<|im_end|>' || chr(10), '' ORDER BY i), '')) h FROM (SELECT key, unnest(messages) m, generate_subscripts(messages, 1) i FROM oasst_v8) GROUP BY key")
def _(t):
    return t.oasst_v8.where(F.size("messages") > 0).select("key", F.md5(X.render_chat(c("messages"))).alias("h"))


@query("f21_masked", "SELECT c_custkey, CASE WHEN length(trim(c_name)) <= 4 THEN repeat('*', length(trim(c_name))) ELSE left(trim(c_name), 2) || repeat('*', length(trim(c_name)) - 4) || right(trim(c_name), 2) END masked FROM customer")
def _(t):
    return t.customer.select("c_custkey", X.masked(c("c_name")).alias("masked"))


@query("f22_card_numbers", "SELECT o_orderkey, list_sum([CASE WHEN i % 2 = 1 THEN CASE WHEN 2 * substr(s, i, 1)::int > 9 THEN 2 * substr(s, i, 1)::int - 9 ELSE 2 * substr(s, i, 1)::int END ELSE substr(s, i, 1)::int END FOR i IN range(1, 17)]) % 10 = 0 AS valid FROM (SELECT o_orderkey, '4' || lpad(o_orderkey::varchar, 15, '1') s FROM orders)")
def _(t):
    return t.orders.select("o_orderkey", X.is_card_number(F.concat(F.lit("4"), F.lpad(c("o_orderkey").cast("string"), 15, "1"))).alias("valid"))


@query("f23_edit_similarity", "SELECT p_partkey, round(CASE WHEN greatest(length(a), length(b)) = 0 THEN 1 ELSE 1 - levenshtein(a, b)::double / greatest(length(a), length(b)) END, 6) similarity FROM (SELECT p_partkey, lower(trim(p_brand)) a, lower(trim(p_type)) b FROM part)")
def _(t):
    return t.part.select("p_partkey", r6(X.edit_similarity(c("p_brand"), c("p_type"))).alias("similarity"))


@query("f24_subjects", r"SELECT o_orderkey, regexp_replace('Re: Fwd: ' || o_orderpriority, '^(?i:re:|fwd:|fw:)\s*', '') subject FROM orders")
def _(t):
    return t.orders.select("o_orderkey", X.clean_subject(F.concat(F.lit("Re: Fwd: "), "o_orderpriority")).alias("subject"))


_EXTENSIONS = "pdf docx doc txt md rtf odt html xlsx xls csv tsv ods jpg jpeg png gif bmp tiff webp svg mp3 wav m4a ogg flac aac wma mp4 avi mkv mov wmv flv webm zip tar gz rar 7z bz2 ts js py rs go java c cpp h exe nothing".split()


@query("f25_file_kinds", f"""SELECT c_custkey, CASE WHEN i < 8 THEN 'document' WHEN i < 13 THEN 'spreadsheet' WHEN i < 21 THEN 'image' WHEN i < 28 THEN 'audio' WHEN i < 35 THEN 'video' WHEN i < 41 THEN 'archive' WHEN i < 50 THEN 'code' ELSE 'other' END kind,
 lower('/home/user/data/' || c_custkey) path FROM (SELECT c_custkey, c_custkey % {len(_EXTENSIONS)} i FROM customer)""")
def _(t):
    ext = F.element_at(F.array(*(F.lit(("." if e != "nothing" else "") + (e.upper() if i % 3 == 0 else e)) for i, e in enumerate(_EXTENSIONS))), (c("c_custkey") % len(_EXTENSIONS) + 1).cast("int"))
    return t.customer.select("c_custkey", X.file_kind(F.concat(F.lit("a.b/report"), ext), W.FILE_KINDS).alias("kind"), X.clean_path(F.concat(F.lit("~//Data/"), c("c_custkey").cast("string"), F.lit("/"))).alias("path"))


@query("f27_haversine", "SELECT s_suppkey, round(2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians(b1 - a1) / 2), 2) + cos(radians(a1)) * cos(radians(b1)) * pow(sin(radians(b2 - a2) / 2), 2)))), 4) km FROM (SELECT s_suppkey, (s_suppkey % 90)::double a1, (s_suppkey % 180)::double a2, s_nationkey::double b1, (s_nationkey * 7)::double b2 FROM supplier)")
def _(t):
    k, n = c("s_suppkey"), c("s_nationkey")
    return t.supplier.select("s_suppkey", F.round(X.haversine_km((k % 90).cast("double"), (k % 180).cast("double"), n.cast("double"), (n * 7).cast("double")), 4).alias("km"))


@query("f28_grid_points", "SELECT n_nationkey, i::int i, round(n_nationkey + (i // 3 - 1) * 10.0 / 3 / 111.0, 6) lat, round(n_nationkey * 3 + (i % 3 - 1) * 10.0 / 3 / (111.0 * cos(radians(n_nationkey))), 6) lon FROM nation, range(9) r(i)")
def _(t):
    g = X.grid_points(c("n_nationkey").cast("double"), (c("n_nationkey") * 3).cast("double"), F.lit(10.0), 9)
    return t.nation.select("n_nationkey", F.explode(g).alias("p")).select("n_nationkey", "p.*")


@query("f29_bin_centres", "SELECT o_orderkey, unnest([floor(epoch(o_orderdate) + 86400.0 / 4 * i + 86400.0 / 8)::bigint for i in range(4)]) centre FROM orders WHERE o_orderkey % 10 = 0 OR true")
def _(t):
    return t.orders.select("o_orderkey", F.explode(X.bin_centres(c("o_orderdate"), c("o_orderdate") + F.expr("interval 1 day"), 4)).alias("centre"))


@query("f30_boxes", "SELECT l_orderkey, l_linenumber, CASE WHEN x2 > x1 AND y2 > y1 THEN round(x2 / 100.0, 4) END x2 FROM (SELECT l_orderkey, l_linenumber, l_linenumber x1, 3 y1, (l_quantity::bigint) x2, 9 y2 FROM lineitem)")
def _(t):
    s = F.format_string("<%d><3><%d><9>", c("l_linenumber").cast("int"), c("l_quantity").cast("int"))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.try_element_at(X.parse_box(s), F.lit(3)).alias("x2"))


@query("f32_multi_hot", "SELECT c_custkey, [CASE WHEN c_mktsegment = k THEN 1.0 ELSE 0.0 END FOR k IN ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY']]::double[]::varchar hot FROM customer")
def _(t):
    hot = X.multi_hot(F.array("c_mktsegment"), ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"])
    return t.customer.select("c_custkey", F.concat(F.lit("["), F.array_join(hot.cast("array<string>"), ", "), F.lit("]")).alias("hot"))


@query("f34_metric_keys", "SELECT p_partkey, regexp_replace(regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') k FROM part")
def _(t):
    return t.part.select("p_partkey", X.metric_key(c("p_type")).alias("k"))


@query("f35_search_terms", f"SELECT row_id, array_to_string({S.terms("coalesce(instruction, '')")}, ' ') terms FROM train_smoke")
def _(t):
    return t.train_smoke.select("row_id", F.array_join(X.search_terms(INS(), W.STOPWORDS), " ").alias("terms"))


@query("f36_bigrams", f"SELECT row_id, len(list_distinct(list_transform(list_filter(range(1, len(w)), lambda i: NOT (w[i] IN {tuple(W.STOPWORDS)} AND w[i + 1] IN {tuple(W.STOPWORDS)})), lambda i: w[i] || ' ' || w[i + 1])))::int n_bigrams FROM (SELECT row_id, list_filter(regexp_split_to_array(regexp_replace(lower(coalesce(response, '')), '[^a-z0-9 \\t\\n\\x{{0B}}\\f\\r]', ' ', 'g'), '[ \\t\\n\\x{{0B}}\\f\\r]+'), lambda x: x <> '') w FROM train_smoke)")
def _(t):
    return t.train_smoke.select("row_id", F.size(X.bigram_set(RSP(), W.STOPWORDS)).alias("n_bigrams"))


@query("f37_query_mood", rf"""SELECT pool_id, CASE WHEN regexp_matches(s, '^(go to|open|take me|show me|navigate)\b') THEN 'navigate' WHEN regexp_matches(s, '^(turn|set|enable|disable|restart|reset|pause|block|stop|start|run|change|write|give|suggest|describe|repeat|tell|explain)\b') THEN 'imperative'
 WHEN regexp_matches(s, '\?\s*$') OR regexp_matches(s, '^(how|what|why|when|where|who|which|can|could|is|are|do|does|should)\b') THEN 'question' ELSE 'statement' END mood FROM (SELECT pool_id, lower({S.strip(S.text('instruction'))}) s FROM pool_todo)""")
def _(t):
    return t.pool_todo.select("pool_id", X.query_mood(INS()).alias("mood"))


@query("f39_priorities", r"SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'low' WHEN 2 THEN 'high' ELSE 'medium' END priority FROM part")
def _(t):
    said = ("Critically important: {}", "{} if time permits", "low priority, yet needed ASAP: {}", "today {} whenever")
    s = F.element_at(F.array(*map(F.lit, said)), (c("p_partkey") % 4 + 1).cast("int"))
    return t.part.select("p_partkey", X.task_priority(F.replace(s, F.lit("{}"), c("p_name"))).alias("priority"))


# ---- gates

_coarse = S.case([(f"{S.strip('t')} = ''", "empty"), ("len(w) < 40", "short"), ("len(w) > 1200", "long"), ("length(t) > 4000", "chars"), (f"{S.f1('t')} < 0.55 OR {S.f4('t')} > 0.45", "latin")])


@query("gate01_corpus_coarse", f"SELECT doc_id, {_coarse} reason FROM (SELECT doc_id, coalesce(text, '') t, {S.words(S.text('text'))} w FROM documents)")
def _(t):
    return t.documents.select("doc_id", G.corpus_coarse(c("text")).alias("reason"))


_quality_from = f"(SELECT doc_id, source, coalesce(text, '') t, {S.words(S.text('text'))} w FROM documents)"


@query("gate02_corpus_quality", f"SELECT doc_id, {S.quality('t', 'w')} reason FROM {_quality_from}")
def _(t):
    return t.documents.select("doc_id", G.corpus_quality(c("text")).alias("reason"))


@query("a1_reason_histogram", f"SELECT coalesce(reason, 'kept') AS value, count(*) n FROM (SELECT {S.quality('t', 'w')} reason FROM {_quality_from}) GROUP BY 1")
def _(t):
    from corpusloom.operators.metrics import histogram

    return histogram(t.documents.select(G.corpus_quality(c("text")).alias("reason")), c("reason"), "kept")


_pair = f"(SELECT row_id, coalesce(instruction, '') i, coalesce(response, '') o, lang FROM train_smoke)"
_ref = W.REFUSAL_PAIRS


def _refusal(t: str) -> str:
    return S.has(t, "(?i)" + _ref)


_basic = S.case([(f"{S.has('i', f'[{S.DEV}]')} OR {S.has('o', f'[{S.DEV}]')}", "script"), ("contains(o, '```') OR contains(i, '```')", "fence"), (_refusal("o"), "refusal"), (f"{S.n_words('i')} NOT BETWEEN 2 AND 120", "prompt_words"), (f"{S.n_words('o')} NOT BETWEEN 1 AND 600", "answer_words"), ("length(i) > 1500 OR length(o) > 4000", "length")])


@query("gate03_pair_basic", f"SELECT row_id, {_basic} reason FROM {_pair}")
def _(t):
    return t.train_smoke.select("row_id", G.pair_basic(c("instruction"), c("response")).alias("reason"))


_si, _so = S.strip("i"), S.strip("o")
_strict = S.case([(f"{_si} = '' OR {_so} = ''", "empty"), ("contains(o, '```') OR contains(i, '```')", "fence"), (f"{_refusal('i')} OR {_refusal('o')}", "refusal"), (f"length({_si}) + length({_so}) > 620", "chars"), (f"{S.n_words('i')} < 2 OR {S.n_words('o')} < 2", "words")])


@query("gate04_pair_strict", f"SELECT row_id, {_strict} reason FROM {_pair}")
def _(t):
    return t.train_smoke.select("row_id", G.pair_strict(c("instruction"), c("response")).alias("reason"))


_both = "(i || ' ' || o)"
_scripted = S.case(
    [(f"contains({_both}, '```')", "fence"), (_refusal(_both), "refusal"), (f"{S.runs_in(_both, W.CPT_MARATHI)} > 0", "marathi"), (S.has(_both, f"[{W.GATE_FOREIGN}]"), "foreign_script"), (f"{S.has('i', f'[{S.DEV}]')} <> {S.has('o', f'[{S.DEV}]')}", "script"), ("length(i) + length(o) > 620", "chars"), (f"{S.n_words('o')} < 20", "answer_words"), (f"{S.n_words('i')} < 3", "prompt_words")]
)


@query("gate05_pair_scripted", f"SELECT row_id, {_scripted} reason FROM {_pair}")
def _(t):
    return t.train_smoke.select("row_id", G.pair_scripted(c("instruction"), c("response"), None).alias("reason"))


@query("gate06_metric", "SELECT doc_id, rater, labelled_at FROM labels WHERE coalesce(quality * 25.0, 0) >= 70")
def _(t):
    return t.labels.where(G.metric_at_least(c("quality") * 25.0, 70.0)).select("doc_id", "rater", "labelled_at")


def _language(t: str, lang: str) -> str:
    m, h = S.runs_in(t, W.GATE_MARATHI, True), S.runs_in(t, W.GATE_HINDI, True)
    latin = f"len(regexp_extract_all({t}, {S.q(S.boundary_words(W.GATE_MARATHI_LATIN))})) >= 2"
    tail = f"WHEN {m} > {h} THEN 'marathi_dominated(' || {m} || '>' || {h} || ')' WHEN {m} >= 3 THEN 'marathi_markers(' || {m} || ')'" if lang == "hindi" else f"WHEN {latin} THEN 'marathi_romanised'"
    return f"CASE WHEN {S.strip(t)} = '' THEN 'empty' WHEN {S.has(t, f'[{W.GATE_FOREIGN}]')} THEN 'foreign_script' {tail} END"


@query("gate07_language", f"SELECT row_id, {_language('o', 'hindi')} hindi, {_language('o', 'hinglish')} hinglish FROM {_pair}")
def _(t):
    o = c("response")
    return t.train_smoke.select("row_id", G.language_gate(o, "hindi").alias("hindi"), G.language_gate(o, "hinglish").alias("hinglish"))


@query("gate08_pair_language", f"SELECT row_id, coalesce({_language('o', 'hindi')}, {_language('i', 'hindi')}) reason FROM {_pair}")
def _(t):
    return t.train_smoke.select("row_id", G.pair_language_gate(c("instruction"), c("response"), "hindi").alias("reason"))


@query("gate09_acceptance", f"SELECT key, generated_at, {S.acceptance('o', 'i', 'w', 'budget')} reason FROM (SELECT key, generated_at, budget, coalesce(response, '') o, coalesce(instruction, '') i, {S.words(S.text('response'))} w FROM teacher_gen)")
def _(t):
    return t.teacher_gen.select("key", "generated_at", G.acceptance(c("response"), c("instruction"), F.lit("hindi"), c("budget")).alias("reason"))


@query("gate10_gold", "SELECT key, generated_at, coalesce(len(list_filter(gold, lambda g: contains(lower(coalesce(response, '')), lower(g)))) > 0, false) has_fact FROM teacher_gen")
def _(t):
    return t.teacher_gen.select("key", "generated_at", G.contains_fact(c("response"), c("gold")).alias("has_fact"))


@query("gate11_judge", "SELECT key, generated_at, coalesce(judge, 0) >= 4 passed FROM teacher_gen")
def _(t):
    return t.teacher_gen.select("key", "generated_at", G.judged(F.concat(F.lit("Score: "), F.coalesce("judge", F.lit(0)).cast("string"))).alias("passed"))


_floor = "CASE budget WHEN 'short' THEN 4 WHEN 'medium' THEN 20 WHEN 'long' THEN 45 ELSE 20 END"
_structure = S.case([(f"len(w) < {_floor}", "short"), (f"NOT {S.has('o', W.TERMINAL)}", "truncated"), (f"{S.unique('w')} < 0.92", "repetitive")])


@query("gate12_structure", f"SELECT key, generated_at, {_structure} reason FROM (SELECT key, generated_at, budget, coalesce(response, '') o, {S.words(S.text('response'))} w FROM teacher_gen)")
def _(t):
    return t.teacher_gen.select("key", "generated_at", G.structure(c("response"), c("budget")).alias("reason"))


@query("gate13_release", f"SELECT key, {S.release('i', 'o', 'b')} reason FROM (SELECT key, coalesce(instruction, '') i, coalesce(response, '') o, array_to_string(list_transform(messages, lambda m: coalesce(m.content, '')), ' ') b FROM oasst_v8)")
def _(t):
    return t.oasst_v8.select("key", G.release(c("instruction"), c("response"), F.array_join(F.transform("messages", lambda m: F.coalesce(m.content, F.lit(""))), " "), F.lit(True)).alias("reason"))


@query("gate14_dangling", f"SELECT row_id, {S.dangling('o')} dangling, {S.dangling('o', True)} dangling_fixed FROM (SELECT row_id, coalesce(response, '') o FROM train_smoke)")
def _(t):
    return t.train_smoke.select("row_id", G.dangling(c("response")).alias("dangling"), G.dangling(c("response"), True).alias("dangling_fixed"))


_msg = f"CASE WHEN {S.strip(S.text('m.content'))} = '' THEN 'empty' WHEN {S.has('m.content', f'[{W.GATE_FOREIGN}]')} THEN 'foreign_script' END"


@query(
    "gate15_conversation",
    f"""SELECT key, coalesce(list_filter(list_transform(messages, lambda m: {_msg}), lambda r: r IS NOT NULL)[1],
 CASE WHEN coalesce(len(messages), 0) < 1 THEN 'empty' WHEN messages[-1].role <> 'assistant' THEN 'ends_on_user' WHEN messages[1].role <> 'user' THEN 'starts_on_assistant'
 WHEN len(list_filter(range(2, len(messages) + 1), lambda i: messages[i].role = messages[i - 1].role)) > 0 THEN 'not_alternating' END) reason FROM oasst_v8""",
)
def _(t):
    return t.oasst_v8.select("key", G.conversation(c("messages")).alias("reason"))


@query("gate16_turns", f"SELECT key, len(messages) BETWEEN 4 AND 8 fits, len(list_filter(messages, lambda m: {S.f1(S.text('m.content'))} < 0.5)) > 0 any_latin FROM oasst_v8")
def _(t):
    return t.oasst_v8.select("key", G.conversation_length(c("messages")).alias("fits"), G.any_turn(c("messages"), lambda x: X.script_share_of_text(x) < 0.5).alias("any_latin"))


_n = S.n_words("s")
_hindi_back = "आपके जवाब|आपने कहा|आपने बताया|उस समय|जैसा आपने|इसका मतलब|पिछले प्रश्न|ऊपर बताया|आपके पहले|आपके अनुसार|क्या आपने|जैसा कि|और इसके|उसी के|आपका पहला|पहले आप"


@query("gate18_prompts", f"SELECT pool_id, ({_n} BETWEEN 5 AND 45 AND NOT {S.has('s', _hindi_back)} AND {S.f1('s')} >= 0.7 AND NOT contains(s, chr(10))) hindi, ({_n} BETWEEN 4 AND 45 AND {S.f1('s')} <= 0.35) romanised FROM (SELECT pool_id, {S.strip(S.text('instruction'))} s FROM pool_todo)")
def _(t):
    return t.pool_todo.select("pool_id", G.standalone_prompt(c("instruction"), "hindi").alias("hindi"), G.standalone_prompt(c("instruction"), "romanised").alias("romanised"))


@query("gate19_generated_prompts", rf"""SELECT pool_id, CASE WHEN {S.n_words('s')} BETWEEN 2 AND 14 THEN CASE WHEN {S.f1('s')} >= 0.50 THEN 'hi' WHEN {S.f1('s')} <= 0.05 THEN 'hinglish' END END plang FROM (SELECT pool_id, regexp_replace(regexp_replace(coalesce(instruction, ''), '^[\s\-*•\p{{Nd}}.)]+', ''), '^["''“”]+|["''“”]+$', '', 'g') s FROM pool_todo)""")
def _(t):
    return t.pool_todo.select("pool_id", G.generated_prompt_language(c("instruction")).alias("plang"))


@query("gate20_expanded_prompts", f"SELECT pool_id FROM (SELECT pool_id, {S.strip(S.text('instruction'))} s FROM pool_todo) WHERE {_n} BETWEEN 10 AND 28 AND NOT {S.has('s', '(?i)https?://|[0-9]{3,}|lorem|TODO')} AND {S.has('s', '[?।.!]$')}")
def _(t):
    return t.pool_todo.where(G.expanded_prompt(c("instruction"))).select("pool_id")


@query("gate21_blacklist", "SELECT row_id FROM train_smoke WHERE coalesce(lower(trim(src)), '') NOT IN ('adaption', 'arena')")
def _(t):
    bad = t.spark.createDataFrame([("adaption",), ("arena",)], "_s string")
    return t.train_smoke.withColumn("_s", F.lower(F.trim("src"))).join(F.broadcast(bad), "_s", "left_anti").select("row_id")


@query("gate22_quantile", "SELECT doc_id FROM documents WHERE n_chars <= (SELECT floor(quantile_cont(n_chars, 0.9)) FROM documents)")
def _(t):
    return G.quantile_filter(t.documents.select("doc_id", "n_chars"), "n_chars").select("doc_id")


@query("gate23_castable", "SELECT row_id FROM train_smoke WHERE try_cast(trim(response) AS DOUBLE) IS NOT NULL AND regexp_matches(trim(response), '^[0-9]+$')")
def _(t):
    return t.train_smoke.where(c("response").try_cast("double").isNotNull() & F.trim("response").rlike("^[0-9]+$")).select("row_id")


@query(
    "gate26_anomalies",
    """SELECT event_id, 'range' AS rule, 'value' AS field, CASE WHEN value < 5 THEN 'below minimum' ELSE 'above maximum' END detail FROM events WHERE value < 5 OR value > 95
 UNION ALL SELECT event_id, 'z_score', 'value', 'outlier' FROM events WHERE abs((value - (SELECT avg(value) FROM events)) / (SELECT stddev_pop(value) FROM events)) > 1.5
 UNION ALL SELECT event_id, 'missing', 'event_type', 'missing' FROM events WHERE event_type IS NULL OR event_type = ''
 UNION ALL SELECT event_id, 'pattern', 'event_type', 'no match' FROM events WHERE NOT regexp_matches(event_type, '^[a-m]')""",
)
def _(t):
    rules = [{"rule": "range", "field": "value", "min": 5, "max": 95}, {"rule": "z_score", "field": "value", "threshold": 1.5}, {"rule": "missing", "field": "event_type"}, {"rule": "pattern", "field": "event_type", "pattern": "^[a-m]"}]
    return G.anomalies(t.events.select("event_id", "value", "event_type"), "event_id", rules).drop("value")


@query("gate28_deflections", "SELECT row_id, CASE WHEN (contains(s, 'let me') OR contains(s, 'i''ll now') OR contains(s, 'i will now') OR contains(s, 'next, i')) AND NOT (contains(s, 'done') OR contains(s, 'completed') OR contains(s, 'finished')) THEN 'incomplete' WHEN strlen(s) < 300 AND contains(s, '?') THEN 'question_back' WHEN contains(s, 'i can''t') OR contains(s, 'i cannot') OR contains(s, 'unable to') OR contains(s, 'don''t have access') THEN 'deflected' END kind FROM (SELECT row_id, lower(coalesce(response, '')) s FROM train_smoke)")
def _(t):
    return t.train_smoke.select("row_id", G.deflection(c("response")).alias("kind"))


@query("gate29_like", "SELECT p_partkey FROM part WHERE p_name ILIKE '%red_w%' OR p_type ILIKE '%promo%'")
def _(t):
    return t.part.where(G.like_search("proMO", c("p_type")) | G.like_search("red_W", c("p_name"))).select("p_partkey")


@query("gate30_filters", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 1000")
def _(t):
    return t.orders.where(G.conjunction([c("o_orderstatus") == "O", c("o_totalprice") >= 1000, None])).select("o_orderkey")


@query("gate31_overlaps", "SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' AND o_orderdate + INTERVAL 30 DAY > TIMESTAMP '1995-06-01'")
def _(t):
    d = c("o_orderdate")
    return t.orders.where(G.overlaps(d, d + F.expr("interval 30 days"), F.expr("timestamp_ntz '1995-06-01'"), F.expr("timestamp_ntz '1996-01-01'"))).select("o_orderkey")


@query("gate32_overdue", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate < TIMESTAMP '1997-01-01'")
def _(t):
    return t.orders.where((c("o_orderstatus") != "F") & (c("o_orderdate") < F.expr("timestamp_ntz '1997-01-01'"))).select("o_orderkey")


@query("gate33_eval", f"SELECT row_id, ({S.f1('o')} > 0.55) hindi, ({S.n_words('o')} >= 20 AND {S.f1('o')} < 0.35) hinglish, ({S.n_words('o')} >= 25 AND {S.f4('o')} > 0.7) english FROM {_pair}")
def _(t):
    return t.train_smoke.select("row_id", *(G.eval_gates(c("response"), k).alias(k) for k in ("hindi", "hinglish", "english")))


@query("gate35_release_counts", f"SELECT count(*) n, count(*) FILTER (starts_with({_language('o', 'hindi')}, 'marathi')) other FROM {_pair}")
def _(t):
    return t.train_smoke.select(RSP().alias("o")).agg(F.count("*").alias("n"), F.count_if(G.language_gate(c("o"), "hindi").startswith("marathi")).alias("other"))


# ---- deduplication


@query("d01_content_hash", "SELECT min(doc_id) doc_id, k FROM (SELECT doc_id, sha1(nfc_normalize(text))[:20] k FROM documents WHERE text IS NOT NULL) GROUP BY k")
def _(t):
    d = t.documents.where("text is not null").select("doc_id", X.sha1_key(U.nfc("text"), 20).alias("k"))
    return D.keep_first(d, c("k"), ["doc_id"]).select("doc_id", "k")


_norm = r"nullif(lower(regexp_replace(coalesce(instruction, ''), '^[\s\x{A0}\x{0B}]+|[\s\x{A0}\x{0B}]+$', '', 'g')), '')"


@query("d02_instruction", f"SELECT min(pool_id) pool_id FROM (SELECT pool_id, {_norm} k FROM pool_todo) WHERE k IS NOT NULL GROUP BY k")
def _(t):
    return D.by_text(t.pool_todo.select("pool_id", "instruction"), "instruction", ["pool_id"]).select("pool_id")


@query("d03_gated", f"SELECT min(row_id) row_id FROM (SELECT row_id, lang, {_norm} k FROM train_smoke WHERE {S.n_words(S.text('response'))} >= 10) WHERE k IS NOT NULL GROUP BY lang, k")
def _(t):
    d = t.train_smoke.where(X.word_count(RSP()) >= 10).select("row_id", "lang", D.normal_text(c("instruction")).alias("k")).where("k is not null")
    return D.keep_first(d, F.struct("lang", "k"), ["row_id"]).select("row_id")


@query("d04_conversation", "SELECT min(key) key FROM (SELECT key, list_transform(messages, lambda m: coalesce(lower(trim(m.content)), '')) k FROM oasst_v8) GROUP BY k")
def _(t):
    return D.by_conversation(t.oasst_v8.select("key", "messages"), "messages", ["key"]).select("key")


@query("d05_pools", r"""WITH u AS (SELECT 0 AS pool_rank, key id, instruction, response FROM teacher_gen UNION ALL SELECT 1, key, instruction, response FROM oasst_v8),
 n AS (SELECT pool_rank, id, nullif(lower(regexp_replace(coalesce(instruction, ''), '^[\s\x{A0}\x{0B}]+|[\s\x{A0}\x{0B}]+$', '', 'g')), '') a, nullif(lower(regexp_replace(coalesce(response, ''), '^[\s\x{A0}\x{0B}]+|[\s\x{A0}\x{0B}]+$', '', 'g')), '') b FROM u)
 SELECT min(pool_rank)::int pool_rank, arg_min(id, (pool_rank, id)) id FROM n GROUP BY a, b""")
def _(t):
    pools = [x.select(c("key").alias("id"), "instruction", "response") for x in (t.teacher_gen, t.oasst_v8)]
    return D.across_pools(pools, ["instruction", "response"], ["id"]).select("pool_rank", "id")


@query("d06_prefer", "SELECT key, instruction FROM teacher_gen UNION ALL SELECT key, instruction FROM pool_todo p WHERE NOT EXISTS (SELECT 1 FROM teacher_gen t WHERE t.key = p.key)")
def _(t):
    return D.prefer(t.teacher_gen.select("key", "instruction"), t.pool_todo.select("key", "instruction"), "key")


@query("d07_duplicates", "SELECT count(lower(trim(instruction))) n_rows, count(DISTINCT lower(trim(instruction))) n_distinct, count(lower(trim(instruction))) - count(DISTINCT lower(trim(instruction))) n_duplicates FROM pool_todo")
def _(t):
    return D.duplicate_count(t.pool_todo, "instruction")


@query("d08_fuzzy_records")
def _(t):
    return D.fuzzy_groups(t.part.select("p_partkey", "p_brand", "p_type"), "p_partkey", ["p_brand", "p_type"], 0.85, F.lit(0))


@query("d09_equal_texts", "SELECT sha256(text) AS key, count(*) n, min(doc_id) AS first, max(doc_id) AS last FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) >= 2")
def _(t):
    return D.groups(t.documents.where("text is not null"), X.content_hash(c("text")), "doc_id")


# ---- joins


@query(
    "j01_first_source",
    "SELECT r.row_id, p.found FROM train_smoke r LEFT JOIN (SELECT trim(instruction) k, arg_min(coalesce(src, '?'), pool_id) found FROM pool_todo WHERE instruction IS NOT NULL GROUP BY 1) p ON trim(r.instruction) = p.k",
)
def _(t):
    pool = t.pool_todo.where("instruction is not null").select("pool_id", "instruction", F.coalesce("src", F.lit("?")).alias("source"))
    return J.first_source(t.train_smoke.select("row_id", "instruction"), pool, "instruction", "source", ["pool_id"]).select("row_id", "found")


@query("j02_not_done", "SELECT pool_id FROM pool_todo p WHERE NOT EXISTS (SELECT 1 FROM teacher_gen t WHERE t.key = p.key)")
def _(t):
    return J.not_done(t.pool_todo, t.teacher_gen, "key").select("pool_id")


@query("j03_label_documents", "SELECT l.doc_id, l.rater, l.labelled_at, d.source FROM labels l JOIN documents d ON l.doc_id = d.doc_id")
def _(t):
    d = t.documents.select(c("doc_id").alias("_id"), "source")
    return J.with_parent(t.labels, d, "doc_id", "_id").select("doc_id", "rater", "labelled_at", "source")


@query("j05_reconcile", "SELECT coalesce(a.k, b.k) path, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' WHEN a.h IS NOT DISTINCT FROM b.h THEN 'unchanged' ELSE 'updated' END state FROM (SELECT key k, arg_min(sha256(instruction), pool_id) h FROM pool_todo GROUP BY 1) a FULL JOIN (SELECT key k, arg_min(sha256(instruction), generated_at) h FROM teacher_gen GROUP BY 1) b ON a.k = b.k")
def _(t):
    h = X.content_hash(c("instruction"))
    a = t.pool_todo.where("instruction is not null").groupBy("key").agg(F.min_by(h, "pool_id").alias("h"))
    b = t.teacher_gen.where("instruction is not null").groupBy("key").agg(F.min_by(h, "generated_at").alias("h"))
    return J.reconcile(a, b, "key", "h")


@query("j06_regressions", "SELECT a.doc_id, CASE WHEN a.p AND NOT b.p THEN 'regression' ELSE 'improvement' END change FROM (SELECT doc_id, arg_max(quality >= 2, labelled_at) p FROM labels WHERE quality IS NOT NULL AND labelled_at IS NOT NULL GROUP BY 1) a JOIN (SELECT doc_id, arg_max(quality >= 3, labelled_at) p FROM labels WHERE quality IS NOT NULL AND labelled_at IS NOT NULL GROUP BY 1) b USING (doc_id) WHERE a.p <> b.p")
def _(t):
    ok = t.labels.where("quality is not null and labelled_at is not null")
    return J.compare_runs(ok.select("doc_id", "labelled_at", (c("quality") >= 2).alias("p")), ok.select("doc_id", "labelled_at", (c("quality") >= 3).alias("p")), "doc_id", "p", "labelled_at")


@query("j07_neighbours", """WITH p AS (SELECT n_name near_name, row_number() OVER (ORDER BY sha1(n_name), n_name) - 1 place, count(*) OVER () n FROM nation), w AS (SELECT n_name AS name, ('0x' || left(sha1(n_name), 8))::bigint begins FROM nation),
 a AS (SELECT name, name near_name, -1 AS k FROM w UNION ALL SELECT name, near_name, i FROM w, range(0, 4) r(i), p WHERE i < n AND place = (begins + i) % n AND near_name <> name)
 SELECT name, near_name, rank FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY k)::int AS rank FROM a) WHERE rank <= 3""")
def _(t):
    wanted = t.nation.select(c("n_name").alias("name"), F.array("n_name").alias("near"))
    return J.fill_neighbours(wanted, "name", "near", t.nation.select(c("n_name").alias("near_name")), "near_name", 3)


# All orders count; combinations that none of them has fall back to the means of their status and priority.
@query("j08_weights", """WITH w AS (SELECT o_orderstatus s, o_orderpriority p, avg(o_totalprice) weight FROM orders GROUP BY 1, 2), g AS (SELECT s, p FROM (SELECT DISTINCT o_orderstatus s FROM orders UNION SELECT 'lost'), (SELECT DISTINCT o_orderpriority p FROM orders UNION SELECT 'none'))
 SELECT g.s, g.p, round(coalesce(w.weight, (coalesce((SELECT avg(weight) FROM w x WHERE x.s = g.s), 0.5) + coalesce((SELECT avg(weight) FROM w y WHERE y.p = g.p), 0.5)) / 2), 4) weight FROM g LEFT JOIN w USING (s, p)""")
def _(t):
    o = t.orders.select(c("o_orderstatus").alias("s"), c("o_orderpriority").alias("p"), "o_totalprice", "o_orderkey")
    w = o.groupBy("s", "p").agg(F.avg("o_totalprice").alias("weight"))
    one = t.spark.range(1)
    cells = J.jobs(o.select("s").union(one.select(F.lit("lost"))).distinct(), o.select("p").union(one.select(F.lit("none"))).distinct())
    return J.weight_or_margins(cells, w, ["s", "p"]).select("s", "p", F.round("weight", 4).alias("weight"))


@query("j09_severities", "SELECT event_id, CASE event_type WHEN 'click' THEN 'low' WHEN 'purchase' THEN 'high' ELSE 'medium' END severity FROM events")
def _(t):
    return t.events.select("event_id", J.lookup(c("event_type"), {"click": "low", "purchase": "high"}, "medium").alias("severity"))


@query("j12_jobs", "SELECT n_name, r_name FROM nation, region")
def _(t):
    return J.jobs(t.nation.select("n_name"), t.region.select("r_name"))


@query("j13_numbered", "SELECT 'm:' || row_number() OVER (ORDER BY pool_id) AS key, pool_id FROM pool_todo")
def _(t):
    return J.numbered(t.pool_todo.select("pool_id"), "m", ["pool_id"]).select("key", "pool_id")
