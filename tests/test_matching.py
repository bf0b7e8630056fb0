"""From mails to ranked pairs."""

from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import fields
from millrace.plans import matching

CONFIG = matching.Config(
    skills={"lang": ["Java", "Python"], "db": ["Oracle"]}, phases={"詳細設計": ["詳細設計"], "製造": ["製造"]}, regions={"kanto": ["東京", "渋谷"], "kansai": ["大阪"]}, excluded=[("spam@x.example", None)]
)
DEMAND = "案件のご紹介 募集\n必須スキル: Java・Oracle\n勤務地: 東京\n作業: 詳細設計 製造\n単価: 80万\n年齢: 50歳まで\n商流: 貴社2社先まで\n契約形態: 準委任\n外国籍不可"
SUPPLY = "要員のご紹介 所属 弊社正社員 稼働\n氏名: A.B 34歳\n国籍: 日本\nスキル Java 詳細設計\n最寄駅: JR線 渋谷駅\n単価: 60万"


def mail(name, sender, subject, body, date="2024-01-01"):
    return (name, "t", subject, sender, ["x@y.example"], "", "", date, body, [])


MAILS = [
    mail("d1", "Buyer <buyer@b.example>", "Re: 案件A", DEMAND), mail("d0", "buyer@b.example", "案件A", "案件 old", "2023-12-31"),
    mail("s1", "s@s.example", "要員1", SUPPLY), mail("s2", "s@s.example", "要員2", SUPPLY.replace("60万", "79万")), mail("s3", "s@s.example", "要員3", SUPPLY.replace("34歳", "60歳")),
    mail("s4", "s@s.example", "要員4", SUPPLY.replace("渋谷", "大阪")), mail("s5", "s@s.example", "要員5", SUPPLY.replace("Java", "Python")), mail("s6", "spam@x.example", "要員6", SUPPLY),
    mail("s7", "s@s.example", "要員7", SUPPLY.replace("日本", "ベトナム")), mail("s8", "s@s.example", "要員8", SUPPLY.replace("Java", "Java Oracle")), mail("u1", "u@u.example", None, None),
]


def test_match(spark):
    mails = spark.createDataFrame(MAILS, schemas.MAIL)
    got = matching.match(mails, CONFIG).collect()
    assert sorted((x["demand_id"], x["supply_id"], x["rate"], x["band"], x["seq"]) for x in got) == [("d1", "s1", 0.5, "match_40_59", 1), ("d1", "s8", 1.0, "match_100", 1)]


def test_audit_names_the_first_stage(spark):
    parts = matching.typed(matching.cleaned(spark.createDataFrame(MAILS, schemas.MAIL), CONFIG), CONFIG).cache()
    assert {x["message_id"]: x["mail_type"] for x in parts.collect()} | {"d1": "project", "s1": "resource", "u1": "unknown"} == {x["message_id"]: x["mail_type"] for x in parts.collect()}
    demand, supply = (f(parts.filter(F.col("mail_type") == k), CONFIG).persist() for f, k in ((matching.demands, "project"), (matching.supplies, "resource")))
    audit = {x["supply_id"]: x["first_failed"] for x in matching.matched(demand, supply, CONFIG, audit=True).collect()}
    assert audit == {"s1": None, "s2": "budget", "s3": "age", "s4": "location", "s5": "skills", "s7": "foreign", "s8": None}
    assert {x["supply_id"] for x in matching.matched(demand, supply, CONFIG).collect()} == {k for k, v in audit.items() if v is None}


def test_fields(spark):
    df = spark.createDataFrame([("即日または4月上旬\n精算 140h~180h\n面談: 2回\n並行: なし\n最寄駅: JR山手線 渋谷駅(徒歩)\n返信は a@b.example へ\n株式会社テスト\nTEL",)], "t string")
    t = F.col("t")
    got = df.select(
        fields.start_date(t).alias("start"), fields.settlement(t).alias("hours"), fields.interviews(t).alias("n"), fields.parallel(t).alias("p"), fields.station(t).alias("station"),
        fields.company(t, F.lit("Bob <b@c.example>")).alias("company"), fields.reply_target(t, F.lit(""), F.lit("Bob <B@c.example>")).alias("to"),
        fields.keywords(F.array(F.lit("Java 3年以上"), F.lit("雑談 Go")), ["Java", "JavaScript", "Go"], "雑談", ["Java"]).alias("k"),
    ).first()
    assert (got["start"], got["hours"], got["n"], got["p"], got["station"], got["company"]) == ("即日", "140h~180h", 2, "none", "渋谷", "株式会社テスト")
    assert got["to"]["address"] == "a@b.example" and got["k"] == ["3年以上", "Java"]
    good, bad = fields.valid(spark.createDataFrame([(1, None), (2, "x")], "i int, s string"), {"has s": F.col("s").isNotNull(), "small": F.col("i") < 5})
    assert good.count() == 1 and bad.first()["failed"] == ["has s"]
    report = fields.consistent(good, good, bad)
    assert report["merged"] == 1 and report["errors"] == 1
