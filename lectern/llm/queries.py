"""One query for each operator of this subpackage, with SQL where SQL can express it."""

from __future__ import annotations

from lectern.llm import sql
from lectern.llm.crf import op10_crf
from lectern.llm.langid import op5_langid
from lectern.llm.maxent import op6_maxent
from lectern.llm.merkle import op13_merkle
from lectern.llm.mixing import op2_mixing
from lectern.llm.packing import op12_packing
from lectern.llm.rollups import op8_rollup
from lectern.llm.sharding import op4_sharding
from lectern.llm.simhash import op1_simhash
from lectern.llm.topk import op7_topk
from lectern.llm.warc import op3_warc
from lectern.llm.whitening import op11_whitening
from lectern.llm.winnowing import op9_winnowing

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_mixing": op2_mixing,
    "op3_warc": op3_warc,
    "op4_sharding": op4_sharding,
    "op5_langid": op5_langid,
    "op6_maxent": op6_maxent,
    "op7_topk": op7_topk,
    "op8_rollup": op8_rollup,
    "op9_winnowing": op9_winnowing,
    "op10_crf": op10_crf,
    "op11_whitening": op11_whitening,
    "op12_packing": op12_packing,
    "op13_merkle": op13_merkle,
}

SQL = {
    "op3_warc": sql.OP3,
    "op4_sharding": sql.OP4,
    "op7_topk": sql.OP7,
    "op8_rollup": sql.OP8,
    "op9_winnowing": sql.OP9,
    "op13_merkle": sql.OP13,
}
