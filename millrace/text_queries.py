"""Scans of texts that are put together from columns of the tables, in both engines: the SQL computes what
stands where from the same columns, and reads no text."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import registered, text
from .operators import fields, pairs, places, render, sections
from .queries import query, t

c = F.col
N = "c_custkey"
#: Nations as places: names without blanks, by their number.
PLACES = "(SELECT list(replace(n_name, ' ', '') ORDER BY n_nationkey) FROM nation)"
REGION_OF = "(SELECT list(r_name ORDER BY n_nationkey) FROM nation JOIN region ON n_regionkey = r_regionkey)"


def _regions(spark, d) -> tuple[dict[str, list[str]], list[str]]:
    """The dictionary (25 names, by region), and the names by number."""
    rows = t(spark, d, "nation").join(t(spark, d, "region"), c("n_regionkey") == c("r_regionkey")).orderBy("n_nationkey").select("r_name", F.replace("n_name", F.lit(" "), F.lit("")).alias("name")).collect()
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r["r_name"], []).append(r["name"])
    return out, [r["name"] for r in rows]


def _mails(spark, d, names: list[str], forms: list[str]):
    """Customers with a mail of one of the forms; a, b and x are names of three nations."""
    listed = F.array(*map(F.lit, names))
    key = lambda plus: F.get(listed, ((c("c_nationkey") + plus) % len(names)).cast("int"))
    made = t(spark, d, "customer").select(N, key(0).alias("a"), key(7).alias("b"), key(11).alias("x"))
    return made.select(N, F.expr(f"CASE {N} % {len(forms)} " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(forms)) + " END").alias("mail"))


HOMES = [
    ("concat('氏名: K.T(35歳/男性)\\n最寄: ', b, '線 ', a, '駅(', x, ')')", "at(0)"), ("concat('K.T@', a, ' 30歳')", "at(0)"), ("concat('氏名: A.B ', a, '駅\\n単価: 60万')", "at(0)"),
    ("concat('最寄: 東', b, '、', a)", "at(0)"), ("concat('最寄: (', a, ')')", "at(0)"), ("concat('お住まい:\\n', a, '\\n', b)", "at(0)"), ("concat(b, 'の案件に興味があります')", "'unknown'"), ("'住所: 海外在住'", "'overseas'"),
    ("concat('35歳 / 男性 / ', a, ' / 60万\\n最寄: ', b)", "at(0)"), ("concat('通勤できる範囲です\\n', a, '\\n以上')", "at(0)"), ("concat('連絡先 k.t@', lower(b), '.example\\n最寄駅: ', x)", "at(11)"),
]
WORKS = [
    ("concat(b, 'の会社です\\n勤務地: ', a, '駅')", "at(0)"), ("concat('勤務地\\n未定/', a, '/', b)", "at(0)"), ("concat(a, 'で開発、のち', b)", "at(0)"),
    ("concat('案件名: X\\n1\\n2\\n3\\n4\\n勤務地は相談\\n-----\\n', b, '商事株式会社\\nTEL 03-1')", "NULL"), ("'フルリモート'", "'remote'"), ("concat('勤務地: リモート(', a, ')')", "at(0)"), ("'未定'", "NULL"),
    ("concat('案件名: X\\n1\\n2\\n3\\n4\\n最寄: 東', x, '\\n===\\n', b, 'ビル\\nx@y.example')", "at(11)"),
]


def _expected(forms) -> str:
    cases = " ".join(f"WHEN {i} THEN {v.replace('at(', 'region_of((c_nationkey + ').replace(')', ') % 25)') if v.startswith('at(') else v}" for i, (_, v) in enumerate(forms))
    return f"SELECT {N}, CASE {N} % {len(forms)} {cases} END AS region FROM customer".replace("region_of(", f"list_extract({REGION_OF}, 1 + ")


@query(_expected(HOMES))
def home_places(spark, d):
    regions, names = _regions(spark, d)
    return _mails(spark, d, names, [f for f, _ in HOMES]).select(N, places.home_region(c("mail"), regions).alias("region"))


@query(_expected(WORKS))
def work_places(spark, d):
    regions, names = _regions(spark, d)
    return _mails(spark, d, names, [f for f, _ in WORKS]).select(N, places.work_region(c("mail"), regions).alias("region"))


K, S = f"(1 + {N} % 9)", "lower(c_mktsegment)"
#: (text, required, optional): SQL that both engines know.
SECTIONS = [
    (f"concat('【必須スキル】\\n・Java ', {K}, '年\\n・SQL\\n【尚可】\\n・', {S}, 'の知識\\n【期間】10月')", f"concat('Java ', {K}, '年|SQL')", f"concat({S}, 'の知識')"),
    (f"concat('Required skills: Java・', {S}, ' design\\n  one of the following: review\\n    - Go ', {K}, '\\n    - Rust\\n- Kotlin\\nBest regards\\n- X')", f"concat('Java|', {S}, ' design|Go ', {K}, ' review|Rust review|Kotlin')", "''"),
    (f"concat('職務経歴書\\n自己PR\\n学歴\\n必須スキル\\n・', {S})", "''", "''"),
    (f"concat('必須スキル&#58;\\n・C&#43;&#43; ', {K})", f"concat('C++ ', {K})", "''"),
    (f"concat('必須条件\\n・PM ', {K}, '年\\n単価: 60万\\n・', {S}, '\\n', {S}, 'の経験があれば尚可')", f"concat('PM ', {K}, '年')", f"concat({S}, 'の経験があれば尚可')"),
    (f"concat('技術要素: Go, ', {S})", f"concat('Go, ', {S})", "''"),
    (f"concat('必須\\n  AWSの構築経験 ', {K}, '年\\n  お待ちしております、何卒ご検討ください\\n歓迎スキル\\n  協調性のある方\\n※', {S}, '\\nご提案をお待ちしております')", f"concat('AWSの構築経験 ', {K}, '年')", "'協調性のある方'"),
    (f"concat('歓迎: ', {S}, '\\n必須: SQL\\n・Java ', {K}, '\\n・Java ', {K}, '\\n-----\\n・Perl')", f"concat('SQL|Java ', {K})", S),
    (f"concat('Must have\\n- any of the following: cloud\\n  - AWS ', {K}, '\\n  - one of the following\\n    - ', {S}, '\\n- ', {S}, ' alone')", f"concat('AWS ', {K}, ' cloud|', {S}, ' cloud|', {S}, ' alone')", "''"),
]
_form = lambda i: f"CASE {N} % {len(SECTIONS)} " + " ".join(f"WHEN {k} THEN {s[i]}" for k, s in enumerate(SECTIONS)) + " END"


@query(f"SELECT {N}, {_form(1)} AS required, {_form(2)} AS optional FROM customer")
def section_items(spark, d):
    found = sections.sectioned(t(spark, d, "customer").select(N, F.expr(_form(0)).alias("text")))
    return found.select(N, F.array_join("required_skills", "|").alias("required"), F.array_join("optional_skills", "|").alias("optional"))


@query(f"SELECT {N}, concat_ws(chr(10), 'Case: ' || c_name, 'a', 'b', 'c', 'd', CASE {N} % 3 WHEN 0 THEN 'at ' || c_name WHEN 1 THEN concat_ws(chr(10), '株式会社', '営業 単価: ' || c_name, 'TEL ' || c_name) END) AS kept FROM customer")
def signatures_cut(spark, d):
    """Behind a case a signature of weak, blank and ruled lines up to a phone; with an address before it, with a price
    in it (then nothing is cut), or alone."""
    made = F.expr(f"concat_ws('\\n', 'Case: ' || c_name, 'a', 'b', 'c', 'd', CASE {N} % 3 WHEN 0 THEN 'at ' || c_name WHEN 1 THEN concat_ws('\\n', '株式会社', '営業 単価: ' || c_name) END, CASE WHEN {N} % 3 <> 1 THEN concat_ws('\\n', '', '======', c_mktsegment || '株式会社', '営業部', '') END, 'TEL ' || c_name)")
    return t(spark, d, "customer").select(N, sections.trim_signature(made, "^Case:", "^TEL").alias("kept"))


@query(
    f"SELECT {N}, line, label, value FROM (SELECT {N}, unnest([{{'line': 0, 'label': 'Name', 'value': c_name}}, {{'line': 1, 'label': 'Name', 'value': 'of ' || c_mktsegment}}, {{'line': 4, 'label': NULL, 'value': 'free'}}, {{'line': 6, 'label': '最寄', 'value': c_name}}], recursive := true) FROM customer)"
)
def labelled_lines(spark, d):
    """From SQL, through the registered table function."""
    registered.register(spark)
    t(spark, d, "customer").selectExpr(N, "concat('Name: ', c_name, '\\nof ', c_mktsegment, '\\n\\n \\nfree\\n【最寄】:\\n', c_name) AS mail").createOrReplaceTempView("_mails_of_customers")
    return spark.sql(f"SELECT {N}, l.at AS line, l.label, l.value FROM _mails_of_customers, LATERAL labelled_lines(mail) AS l")


@query(f"SELECT {N}, 'Java|' || c_mktsegment AS found, concat('必須 ', c_mktsegment) AS folded, {K} || '年|SQL' AS wanted FROM customer")
def registered_functions(spark, d):
    """nfkc, terms and skills, called from SQL."""
    registered.register(spark, {"languages": ["Java", "SQL"], "fields": ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE"]})
    t(spark, d, "customer").createOrReplaceTempView("_customers")
    return spark.sql(
        f"SELECT {N}, array_join(terms(concat('JavaScript, Java & ', c_mktsegment)), '|') AS found, nfkc(concat('必須\\u3000', c_mktsegment)) AS folded, "
        f"array_join(skills(concat('必須スキル:\\n・', {K}, '年\\n・SQL')).required_skills, '|') AS wanted FROM _customers"
    )


@query(f"SELECT {N}, 'Offer of ' || c_name || ' [DOMAIN]' || chr(10) || 'to [EMAIL], LINE ID: [CHAT]' AS text, CASE WHEN {N} % 2 = 0 THEN 'ad,rule' ELSE 'ad' END AS reasons FROM customer")
def sanitised_mails(spark, d):
    """Greetings at the ends, dropped lines, an own host, an address and an id of a chat."""
    made = F.expr(
        f"concat_ws('\\n', 'Hello all,', '====', 'BUY ' || c_mktsegment, CASE WHEN {N} % 2 = 0 THEN '#rule' END, 'Offer of ' || c_name || ' own.example', concat('to u', {N}, '@mail.example, LINE ID: u_', {N}), '', 'Best wishes')"
    )
    found = t(spark, d, "customer").select(N, text.sanitised(made, [("ad", "^BUY"), ("rule", "^#")], ["own.example"]).alias("s"))
    return found.select(N, "s.text", F.array_join("s.reasons", ",").alias("reasons"))


@query(f"SELECT {N}, CASE {N} % 3 WHEN 0 THEN 'JavaScript|' || c_mktsegment WHEN 1 THEN c_mktsegment || '|Java' ELSE {K} || '年|Java' END AS found FROM customer")
def keywords_by_spans(spark, d):
    """A term inside of a longer one, one behind a letter, and years first where all terms are generic."""
    segments = ["BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE"]
    said = F.expr(f"CASE {N} % 3 WHEN 0 THEN array('JavaScript, ' || lower(c_mktsegment), 'noise Java') WHEN 1 THEN array('x' || c_mktsegment || ' ' || c_mktsegment, 'java') ELSE array(concat('Java ', {K}, '年')) END")
    return t(spark, d, "customer").select(N, F.array_join(fields.keywords(said, ["Java", "JavaScript", *segments], "noise", ["Java"]), "|").alias("found"))


@query(
    f"SELECT {N}, CASE {N} % 4 WHEN 0 THEN 'u' || {N} || '@a.example' WHEN 1 THEN 'head@h.example' WHEN 2 THEN 'a@x.example,b' || {N} || '@x.example' ELSE 'head@h.example' END AS recipients, "
    f"CASE {N} % 4 WHEN 0 THEN 'c@c.example' ELSE 'old@h.example' END AS copies, {N} % 4 >= 2 AS ambiguous, CASE WHEN {N} % 4 IN (0, 2) THEN 'text' ELSE 'header' END AS source FROM customer"
)
def correspondents_of_mails(spark, d):
    said = F.expr(f"CASE {N} % 4 WHEN 0 THEN concat(c_name, '\\nTo: U', {N}, '@a.example\\nCC: c@c.example') WHEN 1 THEN concat('write to us, ', c_name) WHEN 2 THEN concat('返信は a@x.example へ\\nmail to: b', {N}, '@x.example') ELSE concat('To: ', c_name) END")
    found = t(spark, d, "customer").select(N, fields.correspondents(said, F.lit("Head <head@h.example>"), F.array(F.lit("old@h.example"))).alias("f"))
    return found.select(N, F.array_join("f.to", ",").alias("recipients"), F.array_join("f.cc", ",").alias("copies"), "f.ambiguous", "f.source")


@query(
    f"SELECT {N}, CASE WHEN {N} % 5 = 0 THEN NULL WHEN {N} % 5 < 3 THEN '弊社' || CASE WHEN {N} % 2 = 0 THEN '個人事業主' ELSE '社員' END ELSE ({N} % 5 - 2)::VARCHAR || '社先' || CASE WHEN {N} % 2 = 0 THEN '個人事業主' ELSE '社員' END END AS affiliation, "
    f"CASE {N} % 3 WHEN 0 THEN c_mktsegment WHEN 1 THEN '外国籍可' ELSE '外国籍不可' END AS foreigners, CASE WHEN {N} % 2 = 0 THEN '日本国籍想定' ELSE c_name END AS nationality, "
    f"CASE WHEN {N} % 2 = 0 THEN c_name ELSE '並行提案中' END AS parallel, CASE WHEN {N} % 2 = 0 THEN 'text' ELSE 'default' END AS parallel_source FROM customer"
)
def derived_labels(spark, d):
    flow = F.expr(f"CASE {N} % 5 WHEN 1 THEN 10 WHEN 2 THEN 11 WHEN 3 THEN 20 WHEN 4 THEN 21 END")
    kind, even = F.when(c(N) % 2 == 0, "freelance").otherwise("employee"), c(N) % 2 == 0
    said = F.when(even, F.concat(F.lit("並行状況: "), "c_name", F.lit("\n")))
    parallel = render.parallel_label(F.lit("x"), said)
    return t(spark, d, "customer").select(
        N, render.affiliation_label(flow, kind)["label"].alias("affiliation"), render.foreign_label(c(N) % 3 == 1, F.when(c(N) % 3 == 0, c("c_mktsegment")))["label"].alias("foreigners"),
        render.nationality_label(F.when(even, "japanese").otherwise("foreign"), F.when(~even, c("c_name")))["label"].alias("nationality"), parallel["label"].alias("parallel"), parallel["source"].alias("parallel_source"),
    )


@query(
    f"SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'd' || o_custkey END AS demand_id, 's' || o_orderkey AS supply_id, CASE WHEN o_orderkey % 4 = 1 THEN o_orderpriority ELSE o_orderstatus END AS required, "
    f"CASE o_orderkey % 4 WHEN 0 THEN 'no demand_id' WHEN 2 THEN 'no optional_skills' ELSE '' END AS errors FROM orders"
)
def records_of_two_layouts(spark, d):
    key = c("o_orderkey")
    nested = F.when(key % 4 == 1, F.struct(F.concat(F.lit("d"), "o_custkey").alias("message_id"), F.array("o_orderpriority").alias("required_skills")))
    records = t(spark, d, "orders").select(
        "o_orderkey", nested.alias("project_info"), F.struct(F.concat(F.lit("s"), key).alias("message_id")).alias("resource_info"), F.when(key % 4 != 0, F.concat(F.lit("d"), "o_custkey")).alias("demand_id"),
        F.array("o_orderstatus").alias("required_skills"), F.when(key % 4 != 2, F.array().cast("array<string>")).alias("optional_skills"),
    )
    return fields.normalised(records, ["o_orderkey"]).select("o_orderkey", "demand_id", "supply_id", F.array_join("required_skills", ",").alias("required"), F.array_join("errors", ",").alias("errors"))


SETS = "SELECT user_id, list_sort(list(DISTINCT event_type)) AS s FROM events GROUP BY user_id"


@query(f"SELECT user_id, array_to_string(list_filter(s, lambda x: x <> 'click' AND x IN ('purchase', 'click', 'signup')), ',') AS matched, len(list_filter(s, lambda x: x <> 'click' AND x IN ('purchase', 'signup'))) > 0 AS met FROM ({SETS})")
def shared_skill_lists(spark, d):
    sets = t(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("s"))
    found = pairs.shared_skills(c("s"), F.array(F.lit("signup"), F.lit("click"), F.lit("purchase")), None, ["click"])
    return sets.select("user_id", F.array_join(found["matched"], ",").alias("matched"), found["met"].alias("met"))
