"""The corpus queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

from . import op01_licenses, op02_ann, op03_toxicity, op04_repeats, op05_lines, op06_decontaminate, op07_quality, op08_reshard, op09_mix, op10_simhash


def queries() -> dict:
    return {
        "op1_licenses": op01_licenses.op1_licenses,
        "op2_ann": op02_ann.op2_ann,
        "op3_toxicity": op03_toxicity.op3_toxicity,
        "op4_repeats": op04_repeats.op4_repeats,
        "op5_line_dedup": op05_lines.op5_line_dedup,
        "op6_decontaminate": op06_decontaminate.op6_decontaminate,
        "op7_quality": op07_quality.op7_quality,
        "op8_reshard": op08_reshard.op8_reshard,
        "op9_mix": op09_mix.op9_mix,
        "op10_simhash": op10_simhash.op10_simhash,
    }


def oracle_sql() -> dict:
    return {
        "op1_licenses": op01_licenses.ORACLE,
        "op2_ann": op02_ann.ORACLE,
        "op4_repeats": op04_repeats.ORACLE,
        "op5_line_dedup": op05_lines.ORACLE,
        "op6_decontaminate": op06_decontaminate.ORACLE,
    }
