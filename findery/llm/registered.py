"""The registered queries of the subpackage and their SQL."""

from findery.llm.ann import op1_nearest
from findery.llm.collocations import OP13_SQL, op13_collocations
from findery.llm.mixer import op5_mixer
from findery.llm.mixing import OP8_SQL, op8_mixing
from findery.llm.neardup import OP7_SQL, op7_near_duplicates
from findery.llm.packing import op4_packing
from findery.llm.periodic import op11_runs
from findery.llm.pieces import op12_pieces
from findery.llm.pii import op6_pii
from findery.llm.quality import op10_quality
from findery.llm.secrets import OP3_SQL, op3_secrets
from findery.llm.topk import OP2_SQL, op2_top_k
from findery.llm.toxicity import op9_toxicity

QUERIES = {
    "op1_nearest": op1_nearest,
    "op2_top_k": op2_top_k,
    "op3_secrets": op3_secrets,
    "op4_packing": op4_packing,
    "op5_mixer": op5_mixer,
    "op6_pii": op6_pii,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_runs": op11_runs,
    "op12_pieces": op12_pieces,
    "op13_collocations": op13_collocations,
}

SQL = {
    "op2_top_k": OP2_SQL,
    "op3_secrets": OP3_SQL,
    "op7_near_duplicates": OP7_SQL,
    "op8_mixing": OP8_SQL,
    "op13_collocations": OP13_SQL,
}
