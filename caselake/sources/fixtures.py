"""Court-shaped landing tables derived from a TPC-H-like star schema.

Stands in for the nightly extracts: every landing table is a DataFrame over the
given parquet tables, row for row, with planted defects (missing keys, bad
codes, re-deliveries, late deletes). Nothing here is collected or sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.plans.reports import PENAL_CODE_GROUPS, STATUTE_GROUPS


class Landing:
    """Landing tables by source name over one folder of parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __call__(self, source: str) -> DataFrame:
        return getattr(self, source)()

    def cases(self) -> DataFrame:
        o, c, n, r = (self.base(t) for t in ("orders", "customer", "nation", "region"))
        key, cust = F.col("o_orderkey"), F.col("c_custkey")
        born = F.date_sub(F.lit("1990-01-01").cast("date"), (cust % 15000).cast("int")).cast("string")
        return (
            o.join(c, o.o_custkey == c.c_custkey)
            .join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            # every tenth case is delivered a second time
            .withColumn("wave", F.explode(F.when(key % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select(
                F.col("c_name").alias("accusedname"),
                _case_no(),
                F.when(key % 97 != 0, key.cast("string")).alias("casepid"),
                F.when(F.col("o_orderstatus") == "F", " disp ")
                .when(F.col("o_orderstatus") == "O", "PEND")
                .when(key % 2 == 0, "AMAL")
                .otherwise("DNATA")
                .alias("casestatus"),
                F.concat("o_orderpriority", F.lit(" v"), F.col("wave").cast("string")).alias("casetitle"),
                F.col("n_name").alias("directorate"),
                F.col("r_name").alias("division"),
                F.when(cust % 29 == 0, "2999-01-01").when(cust % 31 == 0, "n/a").otherwise(born).alias("dob"),
                _gender(),
                F.concat(F.lit('{"priority":"'), "o_orderpriority", F.lit('"}')).alias("Q_IODETAILS"),
                F.when(key % 59 == 0, '{"bad":"1"}').alias("_rescued_data"),
                F.concat(F.lit("cases_"), F.col("wave").cast("string"), F.lit(".csv")).alias("_source_file"),
                _month("o_orderdate").alias("_file_date"),
                (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("wave"))).alias("_ingested_at"),
            )
        )

    def assignments(self) -> DataFrame:
        l, s, n, r = (self.base(t) for t in ("lineitem", "supplier", "nation", "region"))
        supp = F.col("l_suppkey")
        moved = (supp % 5 == 0) & (F.to_date("l_shipdate") >= F.lit("1998-01-01").cast("date"))
        return (
            l.join(s, l.l_suppkey == s.s_suppkey)
            .join(n, s.s_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey)
            .select(
                F.col("l_orderkey").cast("string").alias("pid"),
                F.col("r_name").alias("cluster"),
                F.when(supp % 43 != 0, F.col("s_name")).alias("name"),
                supp.cast("string").alias("officerid"),
                F.when(moved, F.concat("n_name", F.lit(" B"))).otherwise(F.col("n_name")).alias("team"),
                *_shipped("assigned.csv"),
            )
        )

    def charges(self) -> DataFrame:
        offence = F.to_date("l_shipdate")
        filing = F.date_add(offence, F.col("l_quantity").cast("int") - 5)
        return self.base("lineitem").select(
            F.col("l_orderkey").cast("string").alias("pid"),
            _charge_no(),
            F.when(F.col("l_returnflag") == "N", "DAC").when(F.col("l_returnflag") == "A", "MAC").otherwise("XXX").alias("chargetype"),
            F.when(F.col("l_linestatus") == "O", " Pending").otherwise("SENTENCED").alias("chargestatus"),
            offence.cast("string").alias("offencedt"),
            filing.cast("string").alias("filingdt"),
            *_shipped("charges.csv"),
        )

    def offences(self) -> DataFrame:
        l, p = self.base("lineitem"), self.base("part")
        return l.join(p, l.l_partkey == p.p_partkey).select(
            F.col("l_orderkey").cast("string").alias("pid"),
            F.col("l_linenumber").cast("string").alias("chargeno"),
            F.col("p_type").alias("acttitle"),
            F.col("p_brand").alias("reference"),
            F.when(F.col("l_returnflag") == "N", "M")
            .when(F.col("l_returnflag") == "A", "P")
            .when(F.col("l_linestatus") == "O", "R")
            .otherwise("Z")
            .alias("rwpubase"),
            F.col("p_name").alias("description_ntext"),
            *_shipped("offence.csv"),
        )

    def events(self) -> DataFrame:
        key, kind = F.col("event_id"), F.col("event_type")
        officers = self.base("supplier").agg(F.count(F.lit(1))).scalar()
        waves = F.when(key % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        day = F.make_dt_interval(days=F.col("wave"))
        return (
            self.base("events")
            .withColumn("wave", F.explode(waves))
            .select(
                F.when(key % 61 != 0, F.col("ts")).cast("string").alias("startdtstr"),
                (F.col("ts") + F.make_dt_interval(hours=F.when(key % 23 == 0, -1).otherwise(1))).cast("string").alias("enddtstr"),
                (key % (officers * 10)).cast("string").alias("pid"),
                key.cast("string").alias("id"),
                F.when(key % 67 != 0, F.concat(F.lit("Court "), (F.col("user_id") % 40).cast("string"))).alias("courtnumber"),
                F.when((kind == "signup") & (key % 2 == 0), "FM")
                .when(kind == "signup", "FM_PG")
                .when(kind == "click", "PG")
                .when((kind == "view") & (key % 2 == 0), "PTC")
                .when(kind == "view", "CC")
                .when((kind == "purchase") & (key % 7 == 0), "TRIAL")
                .when((kind == "purchase") & (key % 7 == 1), "PH")
                .when(kind == "purchase", "MITIGATION")
                .when(key % 2 == 0, "SENTENCING")
                .otherwise("OTHER")
                .alias("courteventtype"),
                F.when(F.col("wave") == 1, "VOIDED").when(key % 17 == 0, "VACATED").when(key % 19 == 0, "VOIDED").otherwise("NEW").alias("courteventstatus"),
                F.lit(None).cast("string").alias("_rescued_data"),
                F.concat(F.lit("events_"), F.col("wave").cast("string"), F.lit(".csv")).alias("_source_file"),
                (F.to_date("ts").cast("timestamp_ntz") + day).alias("_file_date"),
                (F.col("ts") + day).alias("_ingested_at"),
            )
        )

    def event_officers(self) -> DataFrame:
        key = F.col("event_id")
        supplier, n = self.base("supplier"), self.base("nation")
        officers = supplier.agg(F.count(F.lit(1))).scalar()
        seats = F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return (
            self.base("events")
            .withColumn("seat", F.explode(seats))
            .withColumn("officer", (F.col("user_id") + F.col("seat") * 7) % officers)
            .join(supplier, F.col("officer") == supplier.s_suppkey)
            .join(n, F.col("s_nationkey") == n.n_nationkey)
            .select(
                key.cast("string").alias("courteventid"),
                F.col("s_suppkey").cast("string").alias("officerid"),
                F.when(key % 71 != 0, F.col("s_name")).alias("name"),
                F.col("n_name").alias("division"),
                F.lit(None).cast("string").alias("_rescued_data"),
                F.lit("event_off.csv").alias("_source_file"),
                F.to_date("ts").cast("timestamp_ntz").alias("_file_date"),
                F.col("ts").alias("_ingested_at"),
            )
        )

    def entities(self) -> DataFrame:
        """Accused on every charge of a first-delivery case, plus a victim on every fifth."""
        key = F.col("o_orderkey")
        accused = F.struct(
            F.col("c_name").alias("entity_name"), F.lit("Accused Person").alias("entity_type"), F.lit("40").alias("entity_age"), _gender().alias("entity_gender")
        )
        victim = F.struct(
            F.concat(F.lit("Victim "), key.cast("string")).alias("entity_name"),
            F.lit("Victim").alias("entity_type"),
            F.lit("150").alias("entity_age"),
            F.lit("F").alias("entity_gender"),
        )
        return (
            self._charged()
            .where(key % 97 != 0)
            .withColumn("e", F.explode(F.when(key % 5 == 0, F.array(accused, victim)).otherwise(F.array(accused))))
            .select(
                _case_no().alias("case_no"),
                _charge_no().alias("charge_no"),
                "e.entity_name",
                "e.entity_type",
                "e.entity_age",
                "e.entity_gender",
                F.when(F.col("e.entity_type") == "Victim", "Self").alias("relationship_to_victim"),
                F.when(key % 4 == 0, "Traffic Offences").when(key % 4 == 1, "Hurt").when(key % 4 == 2, "Theft").alias("offence_group"),
                F.when(key % 7 == 0, "Family Violence").alias("special_type"),
                *_shipped("info.csv"),
            )
        )

    def charge_reports(self) -> DataFrame:
        """One semi-structured report text per charge."""
        key, cust = F.col("o_orderkey"), F.col("c_custkey")
        nl = "\n"
        mapped = F.concat(_one_of(list(STATUTE_GROUPS), F.floor(key / 4)), F.lit(" 1961"))
        statute = F.when(key % 4 < 2, mapped).when(key % 4 == 2, "Penal Code 1871").otherwise("Unmapped Act")
        listed = _one_of(list(PENAL_CODE_GROUPS), F.floor(key / 4))
        section = F.when(key % 8 == 2, F.concat(listed, F.lit("(7)"))).when(key % 8 == 6, listed).otherwise("64(1)")
        victim = F.concat(
            F.lit("### **Victim Particulars**\n* **Name:** victim "),
            F.col("o_custkey").cast("string"),
            F.lit("\n* **Gender/Age:** FEMALE / 30 YEARS\n* **Relationship to Accused:** Self\n"),
        )
        text = F.concat(
            F.lit("**Charge Details** ("),
            _full_case_no(),
            F.lit(" / "),
            F.col("charge"),
            F.lit(")\n* **Name:** "),
            F.lower("c_name"),
            F.lit("\n* **Gender/Age:** "),
            F.when(cust % 2 == 0, "MALE").otherwise("FEMALE"),
            F.lit(" / "),
            (cust % 130).cast("string"),
            F.lit(" YEARS\n* **Statute:** "),
            statute,
            F.lit("\n* **Offence:** Section "),
            section,
            F.lit("\n### **Statement of Offence**\nAt a "),
            F.when(key % 3 == 0, "massage").otherwise("retail"),
            F.lit(" outlet." + nl),
            F.when(key % 7 == 0, "* **Special Type:** Family Violence\n").otherwise(""),
            F.when(key % 5 == 0, victim).otherwise(""),
        )
        charge = self.base("lineitem").select("l_orderkey", _charge_no().alias("charge")).distinct()
        o, c = self.base("orders"), self.base("customer")
        return (
            charge.join(o, charge.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).select("charge", text.alias("text"))
        )

    def model_answers(self) -> DataFrame:
        """Stored answers of an extraction model: fenced, bare and broken JSON."""
        o, c = self.base("orders"), self.base("customer")
        key = F.col("o_orderkey")
        doc = F.concat(F.lit("DOC-"), key.cast("string"))
        body = F.concat(
            F.lit('{"case":"'),
            _full_case_no(),
            F.lit('"'),
            F.when(key % 11 == 0, "").otherwise(F.concat(F.lit(',"charge":"DAC-'), _six_digits(key), F.lit('-2023"'))),
            F.lit(',"accused_name":"'),
            F.lower("c_name"),
            F.lit('","accused_age":'),
            F.when(key % 13 == 0, "null").otherwise(((key % 80) + 7).cast("string")),
            F.lit(',"accused_gender":"M","offence_group":"Hurt","special_type":""'),
            F.when(key % 5 == 0, ',"victim_name":"jane o\'neil","victim_age":30,"victim_gender":"F","victim_relationship_to_accused":"Neighbour"').otherwise(""),
            F.lit("}"),
        )
        answer = (
            F.when(key % 17 == 0, "Sorry, no answer.")
            .when(key % 3 == 0, F.concat(F.lit("Here:\n```json\n"), body, F.lit("\n```\ndone")))
            .when(key % 3 == 1, F.concat(F.lit("```\n"), body, F.lit("\n```")))
            .otherwise(body)
        )
        return o.join(c, o.o_custkey == c.c_custkey).select(doc.alias("doc_id"), answer.alias("answer"))

    def _charged(self) -> DataFrame:
        l, o, c = (self.base(t) for t in ("lineitem", "orders", "customer"))
        return l.join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)


def _one_of(values: list[str], number: Column) -> Column:
    """Every value in turn."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def _month(c: str) -> Column:
    return F.trunc(c, "month").cast("timestamp_ntz")


def _six_digits(number: Column) -> Column:
    """At least six digits; longer numbers stay whole."""
    text = number.cast("string")
    return F.when(F.length(text) < 6, F.lpad(text, 6, "0")).otherwise(text)


def _full_case_no() -> Column:
    return F.concat(F.lit("SC-"), _six_digits(F.col("o_orderkey")), F.lit("-"), F.year("o_orderdate").cast("string"))


def _case_no() -> Column:
    return F.when(F.col("o_orderkey") % 53 != 0, _full_case_no()).alias("caseno")


def _gender() -> Column:
    cust = F.col("c_custkey")
    return F.when(cust % 37 == 0, "X").when(cust % 41 == 0, None).when(cust % 2 == 0, "M").otherwise("F").alias("gender")


def _charge_no() -> Column:
    kind = F.when(F.col("l_returnflag") == "N", "DAC").when(F.col("l_returnflag") == "A", "MAC").otherwise("MCN")
    number = _six_digits(F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return F.concat(kind, F.lit("-"), number, F.lit("-2023")).alias("chargeno")


def _shipped(file: str) -> list[Column]:
    """Lineage of the tables that follow the line items."""
    return [
        F.lit(None).cast("string").alias("_rescued_data"),
        F.lit(file).alias("_source_file"),
        _month("l_shipdate").alias("_file_date"),
        F.col("l_shipdate").alias("_ingested_at"),
    ]
