"""The corpus queries: name -> job, and the SQL for those that SQL can state."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import session as SESSION
from . import archive as Q3
from . import common as C
from . import decontaminate as Q6
from . import licenses as Q2
from . import linedup as Q4
from . import manifest as Q11
from . import mixing as Q8
from . import neardup as Q10
from . import phrases as Q13
from . import quality as Q9
from . import repeats as Q7
from . import surrogates as Q1
from . import toxicity as Q5
from . import urlrules as Q12

QUERIES, ORACLE = {}, {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        def run(spark, sf_dir):
            SESSION.prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle:
            ORACLE[name] = oracle
        return run
    return deco


@query("op9_quality_rules", Q9.ORACLE)
def op9(spark, d):
    return Q9.rules(C.table(spark, d, "documents")).drop("lang", "source")


@query("op8_mixing")
def op8(spark, d):
    return Q8.mix(C.table(spark, d, "documents")).taken().drop("source")


@query("op10_near_dedup")
def op10(spark, d):
    return Q10.near_duplicates(C.table(spark, d, "documents"))


@query("op6_decontaminate")
def op6(spark, d):
    return Q6.leaks(C.table(spark, d, "documents"), C.table(spark, d, "benchmark"))


@query("op5_toxicity")
def op5(spark, d):
    return Q5.toxicity(C.table(spark, d, "documents"), C.table(spark, d, "labels"))


@query("op7_suffix_dedup")
def op7(spark, d):
    return (Q7.remove_repeats(C.table(spark, d, "documents"))
            .select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")))


@query("op3_arc_to_warc", Q3.ORACLE)
def op3(spark, d):
    return Q3.round_trip(C.table(spark, d, "pages"), SESSION.shared_path(spark, "llm-warc"))


@query("op4_line_dedup", Q4.ORACLE)
def op4(spark, d):
    return Q4.dedup(C.table(spark, d, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@query("op2_license_scan", Q2.oracle())
def op2(spark, d):
    return Q2.scan(C.table(spark, d, "documents"))


@query("op1_pii_surrogates")
def op1(spark, d):
    return Q1.replace(C.table(spark, d, "documents"))


@query("op11_merkle_manifest", Q11.ORACLE)
def op11(spark, d):
    return Q11.audit(C.table(spark, d, "documents"))


@query("op12_url_filters", Q12.ORACLE)
def op12(spark, d):
    return Q12.judge(C.table(spark, d, "pages"), Q12.fixed_rules(spark))


@query("op13_collocations", Q13.ORACLE)
def op13(spark, d):
    return Q13.collocations(C.table(spark, d, "documents"))
