"""The operators on mails and fields, and the same in SQL.

Mails are made from rows of ``customer``: each row takes one of some forms and puts its own numbers
into it. The SQL doesn't read the text: it says what each form should give, from the same numbers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions import numbers, text
from .operators import annotate, classify, fields, history, judge, packs, pairs, places, render, rows, scores, sections
from .queries import query, t
from .sources import jsonl
from .storage import scratch

c = F.col
N = "c_custkey"


def _case(forms: Sequence[str]) -> str:
    return f"CASE {N} % {len(forms)} " + " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(forms)) + " END"


#: More cases of ``forms``, with columns of the row in text and answer, in words that both engines know.
EXTRA: dict[str, list[tuple[str, str]]] = {
    "settlements": [(f"concat('精算: ', 100 + {N} % 80, 'h~', 180 + {N} % 60, 'h')", f"concat(100 + {N} % 80, 'h~', 180 + {N} % 60, 'h')")],
    "stations": [("concat('最寄駅: JR山手線 ', c_mktsegment, '駅(徒歩)')", "c_mktsegment")],
    "companies": [("concat('署名\\n株式会社', c_mktsegment, '\\nTEL')", "'株式会社' || c_mktsegment")],
    "reply_targets": [(f"concat('返信は Ann', {N}, '@b.example へ')", f"concat('ann', {N}, '@b.example')")],
    "note_blocks": [("concat('【備考】\\n', c_name, '\\n', c_mktsegment, '\\n\\nc')", "c_name || chr(10) || c_mktsegment")],
    "lines_dropped": [("concat('お世話です\\n', c_name, '\\n---\\n', c_mktsegment, '\\n署名\\nc')", "c_name || chr(10) || c_mktsegment")],
    "urls_near_phrases": [(f"concat(c_name, '\\n配信停止はこちら\\n\\nhttp://x.y/', {N}, '\\nb')", "c_name || chr(10) || 'b'")],
    "cjk_joined": [("concat('必 須 ', c_mktsegment, ' 歓 迎')", "concat('必須 ', c_mktsegment, ' 歓迎')")],
    "synonym_folds": [("concat('御社  ', c_mktsegment, '\\n 迄')", "concat('貴社 ', c_mktsegment, ' まで')")],
    "skill_names": [("concat(c_mktsegment, 'の経験者')", "c_mktsegment")],
    "soft_skills": [("concat(c_mktsegment, 'と協調性')", "false")],
    "failure_reasons": [(f"concat('HTTP 403 of ', c_name, ' no ', {N})", "'sheet[drive] needs permission'")],
    "content_kinds": [("hex(c_name)", "'text'"), ("hex(concat('%PDF-', c_name))", "'pdf'"), ("hex(concat('<html>', c_name))", "'html'")],
    "run_dates": [(f"concat('2024', lpad(cast(1 + {N} % 12 as string), 2, '0'), lpad(cast(1 + {N} % 28 as string), 2, '0'))", f"'2024-' || lpad((1 + {N} % 12)::VARCHAR, 2, '0') || '-' || lpad((1 + {N} % 28)::VARCHAR, 2, '0')")],
    "windows_around": [("concat('0123key', c_name)", "'123key' || left(c_name, 4)")],
    "wildcards": [("concat('abc', c_name)", "true"), (f"concat('ab', {N})", "false")],
    "flexible_labels": [(f"concat('単 価: ', {N})", "true"), (f"concat('単位 ', {N})", "false")],
    "masked_noise": [(f"concat(c_mktsegment, ' http://x.y/', {N}, ' b')", "c_mktsegment || '   b'")],
    "decoded_bodies": [("rtrim('=', translate(base64(cast(c_name as binary)), '+/', '-_'))", "c_name")],
    "parallel_status": [("concat(c_name, '\\n並行: なし')", "'none'"), ("concat(c_name, '\\n並行営業: 3社 ', c_mktsegment)", "'some'")],
    "heading_keys": [("concat('【', c_mktsegment, ' スキル】')", "concat(c_mktsegment, 'スキル')")],
}
#: Queries whose texts also come between lines with columns of the row, which must not mislead.
AMONG = {
    "foreign_allowed", "freelance_allowed", "flow_levels", "contract_types", "nationalities", "employments", "own_remote_type", "remote_type", "vendor_flows", "work_regions", "home_regions", "demand_workload",
    "supply_workload", "age_limit", "own_age", "start_dates", "interview_counts",
}


def forms(name: str, extract: Callable[[Column], Column], *cases: tuple[str, str]) -> None:
    """Registers a query of ``extract`` over mails: (text, expected), both SQL expressions of a customer's columns."""
    cases = (*cases, *EXTRA.get(name, ()), *([(f"concat(c_name, ' / ', c_mktsegment, '\\n', {a}, '\\n', lower(c_mktsegment))", b) for a, b in cases] if name in AMONG else ()))
    made = _case([a for a, _ in cases])

    def run(spark, d):
        mails = t(spark, d, "customer").select("*", F.expr(made).alias("mail"))
        return mails.select(N, extract(c("mail")).alias("value"))

    run.__name__ = name
    query(f"SELECT {N}, {_case([b for _, b in cases])} AS value FROM customer")(run)


A, B = f"(40 + {N} % 50)", f"(95 + {N} % 30)"
AGE_, D = f"(30 + {N} % 30)", f"(20 + 10 * ({N} % 4))"
P = f"(10 + {N} % 70)"

forms(
    "project_price", lambda x: packs.project_price(x)["value"],
    (f"concat('【単価】', {A}, '〜', {B}, '万円')", f"({A} + {B}) * 5000"),
    (f"concat('案件\\n単価: ', {A}, '万〜', {B}, '万円/月')", f"({A} + {B}) * 5000"),
    (f"concat('単価: 〜', {A}, '万')", f"{A} * 10000"),
    (f"concat('単 価: ', {A}, '万円〜(スキル見合い)')", f"{A} * 10000"),
    ("'単価: スキル見合い'", "1000000"),
    (f"concat('時給', 2000 + {N} % 1000, '円')", f"(2000 + {N} % 1000) * 160"),
    (f"concat('日給', 2 + {N} % 3, '万円')", f"(2 + {N} % 3) * 200000"),
    (f"concat('金額 ', {A}, '0,000円')", f"{A} * 10000"),
    (f"concat('単価\\n\\n', {A}, '万程度\\n期間: 長期')", f"{A} * 10000"),
    (f"concat('単価: ', {A}, '-', {B})", f"({A} + {B}) * 5000"),
    ("'単価: 5万'", "NULL"),
    (f"concat('報酬: ', {2}, '万〜', {3}, '万/日')", "500000"),
)
forms(
    "resource_price", lambda x: packs.resource_price(x)["value"],
    (f"concat('氏名: A.B\\n単価: ', {A}, '万円\\n稼働: 即日')", f"{A} * 10000"),
    (f"concat('単金: ', {A}, '〜', {B}, '万')", f"({A} + {B}) * 5000"),
    (f"concat('希望単価: 時給', 3000 + {N} % 500, '円')", f"(3000 + {N} % 500) * 160"),
    ("'単価: 応相談'", "1000000"), ("'単価のない紹介'", "NULL"),
)
forms(
    "age_limit", lambda x: packs.age_limit(x)["value"],
    (f"concat('年齢: ', {AGE_}, '歳まで')", AGE_), (f"concat('年齢制限: ', {AGE_}, '歳以下希望')", AGE_), ("'年齢: 不問'", "100"), (f"concat('年齢: ', {AGE_}, '歳以上NG')", f"{AGE_} - 1"), (f"concat('年齢: ', {AGE_}, '歳未満')", f"{AGE_} - 1"),
    (f"concat('年齢: 25歳〜', {AGE_}, '歳')", AGE_), (f"concat('年齢: ', {AGE_}, '歳〜')", "100"), (f"concat('年齢: ', {D}, '代まで')", f"{D} + 9"), (f"concat('年齢: ', {D}, '代前半まで')", f"{D} + 4"), (f"concat('年齢: 20代〜', {D}, '代半ば')", f"{D} + 4"),
    (f"concat('年齢: ', {D}, '代不可')", f"{D} - 1"), (f"concat('年齢制限: ~', {D}, '代')", f"{D} + 9"), (f"concat('要員は', {AGE_}, '歳くらいまで')", AGE_), (f"concat('年齢: ', {AGE_}, '歳')", AGE_), ("'条件なし'", "100"), ("'【年齢】特になし'", "100"),
)
forms(
    "own_age", lambda x: packs.own_age(x)["value"],
    (f"concat('氏名: K.Y(', {AGE_}, '歳/男)')", AGE_), (f"concat('【年齢】', {AGE_})", AGE_), (f"concat('年齢: ', {D}, '代前半')", f"{D} + 3"), (f"concat('年齢: ', {D}, '代後半')", f"{D} + 7"), (f"concat('年齢: ', {D}, '代')", f"{D} + 5"), ("'氏名: A.B 12歳'", "1"), ("'紹介です'", "1"), (f"concat('名前: T.N(', {AGE_}, '/男性)')", AGE_),
)
forms(
    "remote_type", lambda x: packs.remote(x)["value"],
    ("'フルリモート可'", "'fullremote'"), ("'フルリモ不可'", "'onsite'"), ("'リモート不可'", "'onsite'"), (f"concat('週', 1 + {N} % 4, '日リモート')", "'hybrid'"), ("'週5日リモート'", "'fullremote'"), ("'一部在宅'", "'hybrid'"), ("'リモート併用'", "'hybrid'"), ("'週2日出社'", "'hybrid'"),
    ("'勤務地: 東京(リモート)'", "'hybrid'"), ("'常駐必須'", "'onsite'"), ("'場所: 大阪'", "'onsite'"), ("'完全在宅'", "'fullremote'"), ("'テレワーク可'", "'hybrid'"), ("'在宅勤務なし'", "'onsite'"),
)
forms("remote_days", lambda x: packs.remote(x)["days"], (f"concat('週', 1 + {N} % 4, '日リモート')", f"1 + {N} % 4"), ("'週三日程度の在宅'", "3"), ("'フルリモート'", "NULL"))
forms(
    "foreign_allowed", lambda x: packs.foreign_ok(x)["value"],
    ("'外国籍不可'", "false"), ("'外国籍: NG'", "false"), ("'【外国籍】不可'", "false"), ("'外国籍の方はご遠慮ください'", "false"), ("'日本国籍のみ'", "false"), ("'国籍: 日本'", "false"), ("'外国籍可'", "true"), ("'外国籍: 要相談'", "true"), ("'国籍不問'", "true"), ("'条件なし'", "true"), ("'永住資格必須'", "false"),
)
forms("freelance_allowed", lambda x: packs.freelance_ok(x)["value"], ("'個人事業主不可'", "false"), ("'フリーランス: NG'", "false"), ("'貴社社員のみ'", "false"), ("'個人事業主可'", "true"), ("'フリーランスも歓迎'", "true"), ("'条件なし'", "true"))
forms(
    "demand_workload", lambda x: F.concat_ws("-", packs.workload(x)["min"], packs.workload(x)["max"]),
    (f"concat('稼働率: ', {P}, '%〜', {P} + 10, '%')", f"concat({P}, '-', {P} + 10)"), (f"concat('稼働', {P}, '%')", f"concat({P}, '-', {P})"), (f"concat({P}, '%稼働')", f"concat({P}, '-', {P})"), ("'精算: 140-180h'", "'100-100'"), ("'週3日'", "'100-100'"), ("'フルタイム'", "'100-100'"),
)
forms(
    "supply_workload", lambda x: F.concat_ws("-", packs.own_workload(x)["min"], packs.own_workload(x)["max"]),
    (f"concat('稼働率: ', {P}, '%')", f"concat({P}, '-', {P})"), ("'週3〜4日'", "'60-80'"), ("'週2日以上'", "'40-100'"), ("'週3日まで'", "'20-60'"), ("'週四日'", "'80-80'"), ("'副業希望'", "'20-80'"), ("'フル稼働'", "'100-100'"), ("'週2日リモート'", "'100-100'"), ("'即日'", "'100-100'"),
)
forms(
    "flow_levels", packs.flow_level,
    ("'商流: 貴社2社先まで'", "3"), ("'商流: 御社1社先迄'", "2"), ("'商流制限: 貴社まで'", "1"), ("'商流: 制限なし'", "0"), ("'商流: なし'", "0"), ("'商流: 貴社まで\\n商流: 貴社1社先まで'", "2"), ("'貴社所属まで'", "1"), ("'条件なし'", "0"), ("'貴社社員のみ'", "1"),
)
forms(
    "contract_types", lambda x: packs.contract(x)["value"],
    ("'契約形態: 準委任'", "'quasi_mandate'"), ("'派遣または準委任'", "'quasi_mandate'"), ("'契約: 派遣'", "'dispatch'"), ("'派遣契約となります'", "'dispatch'"), ("'労働者派遣事業許可番号 派13'", "'outsourcing'"), ("'業務委託'", "'outsourcing'"), ("'準委任契約です'", "'quasi_mandate'"),
)
forms("nationalities", lambda x: packs.nationality(x)["value"], ("'国籍: 日本'", "'japanese'"), ("'国籍: 中国'", "'foreign'"), ("'ベトナム籍'", "'foreign'"), ("'外国籍'", "'foreign'"), ("'日本人'", "'japanese'"), ("'氏名: A.B'", "'japanese'"))
forms("employments", lambda x: packs.employment(x)["value"], ("'所属: 個人事業主'", "'freelance'"), ("'弊社正社員'", "'employee'"), ("'BPプロパー'", "'employee'"), ("'フリーランス'", "'freelance'"), ("'氏名: A.B'", "'employee'"))
forms("own_remote_type", lambda x: packs.own_remote(x)["value"], ("'フルリモート希望'", "'fullremote'"), ("'リモート併用'", "'hybrid'"), ("'週2日出社'", "'hybrid'"), ("'即日'", "'onsite'"))
forms("vendor_flows", lambda x: packs.vendor_flow(x, F.lit("a@own.example"), "own.example") + packs.vendor_flow(x, F.lit("a@other.example"), "own.example"), ("'2社先所属'", "34"), ("'1社先'", "32"), ("'BP要員'", "32"), ("'弊社所属'", "30"))
REGIONS = {"kanto": ["東京", "渋谷", "横浜"], "kansai": ["大阪", "京都"]}
forms("work_regions", lambda x: places.work_region(x, REGIONS), ("'京都の会社です\\n勤務地: 東京'", "'kanto'"), ("'勤務地\\n大阪・東京'", "'kansai'"), ("'横浜で開発'", "'kanto'"), ("'フルリモート'", "'remote'"), ("'未定'", "NULL"))
forms("home_regions", lambda x: places.home_region(x, REGIONS), ("'最寄: 東京線 大阪駅'", "'kansai'"), ("'氏名: A.B 最寄駅 渋谷(京都)'", "'kanto'"), ("'海外在住'", "'overseas'"), ("'即日'", "'unknown'"))
forms(
    "mail_types", lambda x: classify.mail_type(F.substring_index(x, "\n", 1), x)["label"],
    ("'要員のご紹介\\n要員のご提案です。氏名: A.B 所属: 弊社'", "'resource'"), ("'案件のご紹介\\n案件名: X\\n作業内容: Y\\n必須: Z\\n勤務地: 東京'", "'project'"), ("'連絡\\nこんにちは'", "'unknown'"), ("'x\\n氏名: A\\n氏名: B\\n氏名: C'", "'resource'"),
    ("'x\\n氏名: A\\n年齢: 30\\n所属: 弊社\\n国籍: 日本'", "'resource'"), ("'募集\\nhello'", "'project'"), ("'見積\\n氏名 必須'", "'ambiguous'"), ("'人材\\nhello'", "'resource'"),
)
forms("start_dates", fields.start_date, ("'即日'", "'即日'"), (f"concat('開始: ', 1 + {N} % 12, '月上旬')", f"concat(1 + {N} % 12, '月上旬')"), (f"concat('2024年', 1 + {N} % 12, '月1日')", f"concat('2024年', 1 + {N} % 12, '月1日')"), ("'未定'", "NULL"))
forms("settlements", lambda x: fields.settlement(x), ("'精算: 140h~180h'", "'140h~180h'"), ("'140-180'", "'140-180'"), ("'なし'", "NULL"))
forms("interview_counts", fields.interviews, (f"concat('面談: ', 1 + {N} % 3, '回')", f"1 + {N} % 3"), ("'打合せ1回'", "1"), ("'なし'", "NULL"))
forms("parallel_status", fields.parallel, ("'並行: なし'", "'none'"), ("'並行営業: 3社'", "'some'"), ("'即日'", "NULL"))
forms("stations", fields.station, ("'最寄駅: JR山手線 渋谷駅(徒歩)'", "'渋谷'"), ("'最寄り: 横浜'", "'横浜'"), ("'即日'", "NULL"))
forms("companies", lambda x: fields.company(x, F.lit("Bob <b@c.example>")), ("'署名\\n株式会社テスト\\nTEL'", "'株式会社テスト'"), ("'署名なし'", "'Bob'"))
forms("reply_targets", lambda x: fields.reply_target(x, F.lit(""), F.lit("Bob <B@c.example>"))["address"], ("'返信は Ann@b.example へ'", "'ann@b.example'"), ("'連絡ください'", "'b@c.example'"))
forms("displays", lambda x: F.concat_ws("/", fields.display(x), fields.display(c(N) * 10000, "price"), fields.display(c(N) % 2 == 0, "flag")), ("': 即日。'", f"concat('即日/', {N}, '万円/', CASE WHEN {N} % 2 = 0 THEN '可' ELSE '不可' END)"), ("' '", f"concat('-/', {N}, '万円/', CASE WHEN {N} % 2 = 0 THEN '可' ELSE '不可' END)"))
forms("note_blocks", lambda x: fields.note_block(x, "備考"), ("'【備考】\\na\\nb\\n\\nc'", "'a' || chr(10) || 'b'"), ("'備考\\na\\n【次】\\nb'", "'a'"), ("'x'", "NULL"))
forms("signatures", lambda x: sections.trim_signature(x, "案件", "TEL"), ("'案件\\n1\\n2\\n3\\n4\\n-----\\nABC社\\nTEL 03'", "'案件' || chr(10) || '1' || chr(10) || '2' || chr(10) || '3' || chr(10) || '4'"), ("'案件\\nTEL 03'", "'案件' || chr(10) || 'TEL 03'"))
forms("lines_dropped", lambda x: rows.drop_lines(x, ["^お世話", "^-+$"], "^署名"), ("'お世話です\\na\\n---\\nb\\n署名\\nc'", "'a' || chr(10) || 'b'"), ("'a'", "'a'"))
forms("urls_near_phrases", lambda x: text.without_urls_near(x, "配信停止"), ("'a\\n配信停止はこちら\\n\\nhttp://x.y\\nb'", "'a' || chr(10) || 'b'"), ("'a\\nhttp://x.y'", "'a' || chr(10) || 'http://x.y'"))
forms("cjk_joined", text.join_cjk, ("'必 須 a b'", "'必須 a b'"), ("'a b'", "'a b'"))
forms("heading_keys", text.heading_key, ("'【必須 スキル】'", "'必須スキル'"), ("'■ 単 価:'", "'単価'"))
forms("synonym_folds", lambda x: text.synonyms(x, flat=True), ("'御社  迄\\n元請け'", "'貴社 まで 元請'"), ("'x'", "'x'"))
forms("skill_names", lambda x: text.strip_modifiers(x, ["の経験", "できる方"]), ("'Javaの経験者'", "'Java'"), ("'調整できる方'", "'調整できる方'"))
forms("soft_skills", lambda x: text.is_soft_skill(x, ["協調性", "コミュニケーション"]), ("'協調性のある方'", "true"), ("'協調性とJava'", "false"), ("'Java'", "false"))
forms("failure_reasons", lambda x: text.failure_reason(F.lit("sheet"), F.lit("drive"), x), ("'HTTP 403'", "'sheet[drive] needs permission'"), ("'404 not found'", "'sheet[drive] not found'"), ("'timed out'", "'sheet[drive] timeout'"), ("'odd'", "'sheet[drive] failed'"))
forms("content_kinds", lambda x: text.content_kind(F.unhex(x), F.lit("application/x")), ("'3C68746D6C3E'", "'html'"), ("'255044462D'", "'pdf'"), ("'504B030400'", "'office'"), ("'D0CF11E0A1B11AE1'", "'ole'"), ("'0001'", "'binary'"), ("'6162'", "'text'"), ("''", "'empty'"))
forms("kanji_digits", numbers.digit, ("'五'", "5"), (f"cast({N} % 10 as string)", f"{N} % 10"), ("'x'", "NULL"))
forms("run_dates", lambda x: numbers.run_date(x).cast("string"), ("'20240229'", "'2024-02-29'"), ("'20240230'", "NULL"), ("'x'", "NULL"))
forms("windows_around", lambda x: text.around(x, "key", 3, 4), ("'0123key4567'", "'123key4567'"), ("'none'", "NULL"))
forms("wildcards", lambda x: text.wildcard(x, "a?c*"), ("'abcd'", "true"), ("'abd'", "false"), ("'ac'", "false"))
forms("flexible_labels", lambda x: x.rlike(text.flexible("単価")), ("'単 価: 1'", "true"), ("'単位'", "false"))
forms("mail_addresses", text.mail_address, ("'Ann <Ann@X.org>'", "'ann@x.org'"), (f"concat(' Bob', {N}, '@y.org ')", f"concat('bob', {N}, '@y.org')"))
forms("masked_noise", text.mask_noise, ("'a http://x.y/z b'", "'a   b'"), ("'〒 123-4567 x'", "'〒   x'"), ("'tel 03-1234-5678'", "'tel  '"))
forms("decoded_bodies", lambda x: jsonl.base64url(x).cast("string"), ("'YWI_'", "'ab?'"), ("'YQ'", "'a'"))


# fields of tables -----------------------------------------------------------------------------------


@query("SELECT c_custkey, CASE WHEN trim(n) <> '' THEN n ELSE c_name END AS chosen, CASE WHEN c_acctbal < 0 THEN 'none' ELSE 'balance' END AS source FROM (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN '  ' ELSE c_mktsegment || ' ' END AS n FROM customer)")
def first_values(spark, d):
    blank = F.when(c(N) % 2 == 0, "  ").otherwise(F.concat("c_mktsegment", F.lit(" ")))
    with_source = text.with_source(("balance", F.when(c("c_acctbal") >= 0, c("c_acctbal"))))
    return t(spark, d, "customer").select(N, text.first_nonempty(blank, c("c_name")).alias("chosen"), with_source["source"].alias("source"))


@query("SELECT user_id, array_to_string(list_transform(list_filter(list_zip(s, range(1, len(s) + 1)), lambda p: list_position(list_transform(s, lambda x: lower(x)), lower(p[1])) = p[2]), lambda p: p[1]), ',') AS kept FROM (SELECT user_id, list_concat(list_sort(list(DISTINCT event_type)), list_transform(list_sort(list(DISTINCT event_type)), lambda x: upper(x))) AS s FROM events GROUP BY user_id)")
def distinct_any_case(spark, d):
    sets = t(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("s"))
    return sets.select("user_id", F.array_join(text.distinct_ignoring_case(F.concat("s", F.transform("s", F.upper))), ",").alias("kept"))


@query("SELECT page_id, url AS found FROM pages")
def urls_in_text(spark, d):
    said = F.concat(F.lit("see ("), c("url"), F.lit("). or"))
    return t(spark, d, "pages").select("page_id", F.array_join(text.urls(said), " ").alias("found"))


@query("SELECT user_id, CASE WHEN length(j) > 20 THEN rtrim(j[1:20]) || '…' ELSE j END AS short FROM (SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type))[1:3], ' / ') AS j FROM events GROUP BY user_id)")
def list_summaries(spark, d):
    sets = t(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("s"))
    return sets.select("user_id", text.summary(c("s"), 3, 20).alias("short"))


@query("SELECT doc_id, md5(CASE WHEN length(text) > 1600 THEN text[1:1600] || '…' ELSE text END) AS digest FROM documents")
def quoted(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(text.quote(c("text"))).alias("digest"))


@query("SELECT doc_id, md5(regexp_replace(text, chr(10) || '{3,}', chr(10) || chr(10), 'g')) AS digest FROM documents")
def squeezed(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(text.squeeze(c("text"), 1)).alias("digest"))


# rows -----------------------------------------------------------------------------------------------


@query("SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def jsonl_files(spark, d):
    path = scratch(spark, "lines")
    jsonl.write_jsonl(t(spark, d, "customer").select(N, "c_name", F.when(c("c_acctbal") >= 0, c("c_acctbal")).alias("balance")), path)
    jsonl.write_jsonl(t(spark, d, "supplier").select(c("s_suppkey").alias(N), c("s_name").alias("c_name"), F.lit(None).cast("double").alias("balance")), path, "append")
    return jsonl.read_jsonl(spark, path, f"{N} bigint, c_name string, balance double").drop("_ord")


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id")
def keyed_last(spark, d):
    events = t(spark, d, "events").select("user_id", "event_type", F.struct("ts", "event_id").alias("_ord"))
    return rows.keep_last(events, ["user_id"], "_ord").drop("_ord")


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def strict_lookup(spark, d):
    nations = t(spark, d, "nation").select(c("n_nationkey").alias("c_nationkey"), "n_name")
    return rows.lookup(t(spark, d, "customer").select(N, "c_nationkey"), nations, "c_nationkey", strict=True).select(N, "n_name")


@query("SELECT c_custkey, n_name, CASE WHEN c_nationkey >= 20 THEN 'no_nation' END AS error FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey")
def lookup_with_errors(spark, d):
    nations = t(spark, d, "nation").filter("n_nationkey < 20").select(c("n_nationkey").alias("c_nationkey"), "n_name")
    good, bad = rows.lookup_or_error(t(spark, d, "customer").select(N, "c_nationkey"), nations, "c_nationkey", "no_nation")
    return good.select(N, "n_name", F.lit(None).cast("string").alias("error")).unionByName(bad.select(N, F.lit(None).cast("string").alias("n_name"), "error"))


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 7)")
def first_rows(spark, d):
    return rows.same_count(t(spark, d, "customer").select(N).orderBy(N).limit(7), spark.range(7))


@query("SELECT r_name, r_regionkey FROM region WHERE r_regionkey <> 2")
def without_sentinels(spark, d):
    marked = t(spark, d, "region").withColumn("status", F.when(c("r_regionkey") == 2, "no_match"))
    rows.required(spark, f"{d}/region.parquet")
    return rows.enabled(rows.without_status(marked), True, lambda x: x.select("r_name", "r_regionkey"))


LED = f"CASE WHEN {N} % 10 = 0 THEN NULL WHEN {N} % 10 = 1 THEN c_acctbal ELSE 0 END"


@query(f"SELECT {N}, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {LED} DESC NULLS LAST, c_name DESC) AS seq FROM customer")
def sequence_in_ranges(spark, d):
    """With groups of more than 50 rows cut into ranges; of ten rows one has no lead and eight the same."""
    led = t(spark, d, "customer").select(N, "c_mktsegment", "c_name", F.expr(LED).alias("lead"))
    return rows.numbered(led, ["c_mktsegment"], [F.desc_nulls_last("lead"), F.desc("c_name")], group_rows=50).select(N, "c_mktsegment", "seq")


@query(f"SELECT {N}, row_number() OVER (ORDER BY {LED} NULLS FIRST, c_name) AS seq FROM customer")
def one_sequence_in_ranges(spark, d):
    led = t(spark, d, "customer").select(N, "c_name", F.expr(LED).alias("lead"))
    return rows.numbered(led, [], [F.asc_nulls_first("lead"), c("c_name")], group_rows=100).select(N, "seq")


@query("SELECT user_id, event_type, arg_min(event_id, ts::VARCHAR || event_id::VARCHAR) AS event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('hour', ts) DESC) AS r, rank() OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('hour', ts) DESC) AS k FROM events) WHERE k = 1 GROUP BY user_id, event_type")
def latest_by_string_tie(spark, d):
    """Of the events of a key's last hour the one with the least text."""
    events = t(spark, d, "events").select("user_id", "event_type", "event_id", F.date_trunc("hour", "ts").alias("hour"), F.concat(F.col("ts").cast("string"), F.col("event_id").cast("string")).alias("tie"))
    return rows.keep_latest(events, ["user_id", "event_type"], "hour", "tie").select("user_id", "event_type", "event_id")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'b3' ELSE 'a3' END AS last, 9::BIGINT - 6 * (c_custkey % 2) AS n FROM customer")
def last_of_files(spark, d):
    """Three versions of each row in the order of lines of one file, and for half of them three more in a later,
    larger file: the last line of the last file counts, although a scan takes the larger file first."""
    path, customers = scratch(spark, "versions"), t(spark, d, "customer")
    version = F.explode(F.sequence(F.lit(1), F.lit(3))).alias("v")
    first = customers.select(N, version).select(N, F.concat(F.lit("a"), "v").alias("last"), F.col("v").alias("n"), F.lit("").alias("pad"))
    second = customers.filter(c(N) % 2 == 0).select(N, version).select(N, F.concat(F.lit("b"), "v").alias("last"), (c("v") + 6).alias("n"), F.repeat(F.lit("x"), F.lit(300)).alias("pad"))
    for name, part in (("a", first), ("b", second)):
        jsonl.write_jsonl(part.coalesce(1).sortWithinPartitions("n", N), f"{path}/{name}")
    both = jsonl.read_jsonl(spark, [f"{path}/b", f"{path}/a"], f"{N} bigint, last string, n bigint, pad string")
    return rows.keep_last(both, [N], "_ord").select(N, "last", "n")


# scores, history, judges --------------------------------------------------------------------------

RATES = "SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') / count(*)::double AS rate, count(*) FILTER (l_linestatus = 'O') / count(*)::double AS other FROM lineitem GROUP BY l_orderkey"


@query(f"SELECT l_orderkey, round(rate + other, 6) AS total, row_number() OVER (ORDER BY rate + other DESC, rate DESC, l_orderkey) AS seq FROM ({RATES})")
def total_score_sort(spark, d):
    flags = lambda x: F.collect_list(F.struct(x.alias("match")))
    found = t(spark, d, "lineitem").groupBy("l_orderkey").agg(flags(c("l_returnflag") == "R").alias("a"), flags(c("l_linestatus") == "O").alias("b"))
    rated = found.select("l_orderkey", scores.match_rate(c("a")).alias("rate"), scores.match_rate(c("b")).alias("other"))
    rated = rated.withColumns({"total": scores.total(c("rate"), c("other")), "all": F.lit(1)})
    ranked = rows.numbered(rated, ["all"], [F.desc("total"), F.desc("rate"), c("l_orderkey")])
    return ranked.select("l_orderkey", F.round("total", 6).alias("total"), c("seq").cast("long").alias("seq"))


@query("SELECT event_type AS item, count(*)::bigint AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY event_type")
def item_frequencies(spark, d):
    return scores.frequencies(t(spark, d, "events").groupBy("user_id").agg(F.collect_list("event_type").alias("s")), "s")


@query("SELECT round(avg(c_acctbal), 4) AS balance, round(avg((c_acctbal >= 0)::int), 6) AS success_rate, avg((c_acctbal >= 0)::int) < 0.9 AS warn FROM customer")
def rates_and_means(spark, d):
    found = scores.averages(t(spark, d, "customer"), {"balance": c("c_acctbal")}, c("c_acctbal") >= 0)
    return found.select(F.round("balance", 4).alias("balance"), F.round("success_rate", 6).alias("success_rate"), "warn")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'human_review' ELSE 'confirmed' END AS recheck_status FROM orders WHERE o_orderstatus IN ('F', 'O')")
def recheck_restriction(spark, d):
    orders = t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    found = history.rechecked(orders.select("o_orderkey"), orders.filter("o_orderstatus IN ('F', 'O')"), orders.filter("o_orderstatus = 'O'"), ["o_orderkey"], "o_orderdate")
    return found.select("o_orderkey", "recheck_status")


@query("WITH r AS (SELECT o_custkey, o_orderpriority, (o_orderdate >= '1998-01-01')::int AS run FROM orders) SELECT o_custkey, o_orderpriority, min(run)::bigint AS run FROM r GROUP BY ALL")
def run_state_snapshots(spark, d):
    """Two runs through RunState; the second's cache has what the first knew, and what is new."""
    keys = ["o_custkey", "o_orderpriority"]
    state = history.RunState(spark, scratch(spark, "runs"))
    none = spark.createDataFrame([], "error string")
    dated = t(spark, d, "orders").select(*keys, F.when(c("o_orderdate") >= F.lit("1998-01-01"), 1).otherwise(0).cast("long").alias("run"))
    first, second = (dated.filter(c("run") == i).distinct() for i in (0, 1))
    state.commit(first.select(*keys), first, none)
    _, new = history.seen_and_new(second, state.read("history"), keys)
    state.commit(second.select(*keys), state.read("cache").unionByName(new), none)
    return state.read("cache")


@query("SELECT o_custkey, l_source, count(*)::bigint AS n FROM (SELECT o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'restored' ELSE 'new' END AS l_source FROM orders) GROUP BY ALL")
def ordered_merge(spark, d):
    orders = t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    result = lambda flag, name: orders.filter((c("o_orderstatus") == "F") == flag).select("o_custkey", "o_orderkey", F.lit(name).alias("l_source"))
    merged, errors = history.merge(orders.select("o_custkey", "o_orderkey"), result(True, "restored"), result(False, "new"), ["o_custkey"], "o_orderkey")
    fields.consistent(merged, orders, errors)
    return merged.groupBy("o_custkey", "l_source").agg(F.count("*").alias("n"))


@query("SELECT conv_id, turn, (len(list_distinct(regexp_split_to_array(lower(q), '[ \\n\\t]+'))))::int AS n, len(list_filter(list_distinct(regexp_split_to_array(lower(q), '[ \\n\\t]+')), lambda w: contains(lower(a), w)))::int AS n_met FROM (SELECT x.conv_id, y.turn, x.text AS q, y.text AS a FROM conversations x JOIN conversations y ON x.conv_id = y.conv_id AND x.turn + 1 = y.turn) WHERE trim(a) <> ''")
def judged_turns(spark, d):
    """Each turn's words, split at white space, against the next turn."""
    turns = t(spark, d, "conversations")
    asked = turns.select("conv_id", (c("turn") + 1).alias("turn"), F.array_distinct(F.split(F.lower("text"), "[ \\n\\t]+")).alias("required_skills"))
    found = judge.judged(asked.join(turns.select("conv_id", "turn", c("text").alias("skillsheet")), ["conv_id", "turn"]))
    return found.filter("error IS NULL").select("conv_id", c("turn").cast("long").alias("turn"), F.size("results").alias("n"), F.size(F.filter("results", lambda r: r["match"])).alias("n_met"))


@query("SELECT user_id, CASE WHEN len(h) > 0 AND (len(p) = 0 OR len(q) > 0) THEN 'sheet' ELSE 'none' END AS source, array_to_string(list_sort(h), ',') AS hits FROM (SELECT user_id, list_intersect(s, ['purchase', 'click']) AS h, ['signup'] AS p, list_intersect(s, ['signup']) AS q FROM (SELECT user_id, list(DISTINCT event_type) AS s FROM events GROUP BY user_id))")
def containment_of_keywords(spark, d):
    sets = t(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("s"))
    words = lambda *w: F.array(*map(F.lit, w)) if w else F.array().cast("array<string>")
    found = sets.withColumn("f", pairs.containment(words("purchase", "click"), words("signup"), c("s"), words()))
    return found.select("user_id", c("f.source").alias("source"), F.array_join(F.array_sort(F.array_intersect("f.hits", words("purchase", "click"))), ",").alias("hits"))


@query("SELECT c_custkey, 'r1_' || c_custkey || '_' || c_nationkey AS proposal_id, CASE WHEN c_acctbal >= 0 THEN 'a' ELSE '' END AS met FROM customer")
def proposals(spark, d):
    results = F.array(F.struct(F.lit("a").alias("skill"), (c("c_acctbal") >= 0).alias("match"), F.lit("n").alias("note")))
    made = render.proposal(F.lit("r1"), {"demand_id": c(N).cast("string"), "supply_id": c("c_nationkey").cast("string")}, results)
    return t(spark, d, "customer").select(N, made["proposal_id"].alias("proposal_id"), F.array_join(made["met"], ",").alias("met"))


@query("SELECT c_custkey, mode, 'to ' || mode || ' ' || c_name AS body FROM customer, (SELECT unnest(['reply_to_project', 'reply_to_resource']) AS mode)")
def reply_drafts(spark, d):
    modes = {m: (F.lit("a@b.example"), F.lit("s"), F.concat(F.lit(f"to {m} "), c("c_name"))) for m in ("reply_to_project", "reply_to_resource")}
    return render.drafts(t(spark, d, "customer").select(N, "c_name"), modes).select(N, "mode", "body")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'x' || c_custkey || '@b.example,y@b.example' ELSE 'z@c.example' END AS recipients FROM customer")
def recipient_lists(spark, d):
    first = F.when(c(N) % 2 == 0, F.concat(F.lit("X"), c(N).cast("string"), F.lit(" <x"), c(N).cast("string"), F.lit("@b.example>, y@b.example, y@B.example")))
    return t(spark, d, "customer").select(N, render.recipients(first, F.lit(" "), F.lit("z@c.example")).alias("recipients"))
