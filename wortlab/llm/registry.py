"""Queries and oracle SQL of the operators in this subpackage, collected from their modules."""

from __future__ import annotations

from . import (op1_chat, op2_warc, op3_langid, op4_quality, op5_packing, op6_simple8b, op7_decontam, op8_simhash, op9_license,
               op10_substring, op11_alignment, op12_transducer, op13_runs)

MODULES = (op1_chat, op2_warc, op3_langid, op4_quality, op5_packing, op6_simple8b, op7_decontam, op8_simhash, op9_license,
           op10_substring, op11_alignment, op12_transducer, op13_runs)
QUERIES = {m.NAME: m.query for m in MODULES}
SQL = {m.NAME: m.SQL for m in MODULES if m.SQL is not None}
