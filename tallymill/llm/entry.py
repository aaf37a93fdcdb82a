"""Queries of the training-data operators, by problem."""

from __future__ import annotations

from tallymill.session import table


def p1_found(spark, sf_dir):
    from tallymill.llm.near import found_near

    return found_near(table(spark, sf_dir, "cluster_demo"), table(spark, sf_dir, "neardup_pairs"))


def p1_groups(spark, sf_dir):
    from tallymill.llm.near import near_groups

    return near_groups(table(spark, sf_dir, "cluster_demo")).selectExpr("rid AS line_no", "grp", "copy")


def p2_found(spark, sf_dir):
    from tallymill.llm.copies import found_copies

    return found_copies(table(spark, sf_dir, "cluster_demo"))


def p2_exchanges(spark, sf_dir):
    from tallymill.llm.copies import collapse_copies

    return collapse_copies(table(spark, sf_dir, "cluster_demo"))


def p6_found(spark, sf_dir):
    from tallymill.llm.pairs import find_defects

    return find_defects(table(spark, sf_dir, "cluster_demo"))


def p7_ids(spark, sf_dir):
    from tallymill.llm.tokenize import token_ids

    return token_ids(table(spark, sf_dir, "documents"))


def p9_found(spark, sf_dir):
    from tallymill.llm.sentences import sentence_units

    return sentence_units(table(spark, sf_dir, "documents"))


def p8_found(spark, sf_dir):
    from tallymill.llm.leaks import found_leaks

    return found_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p4_subset(spark, sf_dir):
    from tallymill.llm.varied import varied_subset

    rows = table(spark, sf_dir, "cluster_demo")
    return varied_subset(rows, max(200, rows.count() // 50))


def p5_found(spark, sf_dir):
    from tallymill.llm.personal import find_personal

    return find_personal(table(spark, sf_dir, "cluster_demo"))


def p5_redacted(spark, sf_dir):
    from tallymill.llm.personal import redact_personal

    return redact_personal(table(spark, sf_dir, "cluster_demo"))


QUERIES = {"p1_found": p1_found, "p1_groups": p1_groups, "p2_found": p2_found, "p2_exchanges": p2_exchanges, "p4_subset": p4_subset, "p5_found": p5_found, "p5_redacted": p5_redacted, "p6_found": p6_found, "p7_ids": p7_ids, "p8_found": p8_found, "p9_found": p9_found}
SQL: dict[str, str] = {}
