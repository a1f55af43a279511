"""The registered queries of this subpackage, with SQL where SQL can say the same."""

from __future__ import annotations

from panelweave.llm.bpe import op5_bpe
from panelweave.llm.embeddings import op4_embeddings
from panelweave.llm.html_text import op12_html_text
from panelweave.llm.mixing import op3_mixing
from panelweave.llm.ngram import op8_lm
from panelweave.llm.quality import op6_quality
from panelweave.llm.repair import op11_conversation_repair
from panelweave.llm.runs import op13_runs
from panelweave.llm.simhash import op10_simhash
from panelweave.llm.spotsigs import op9_spotsigs
from panelweave.llm.substring import op1_substring_dedup
from panelweave.llm.urls import SQL as URL_SQL
from panelweave.llm.urls import op7_url_filter
from panelweave.llm.warc import SQL as WARC_SQL
from panelweave.llm.warc import op2_warc

QUERIES = {
    fn.__name__: fn
    for fn in (
        op1_substring_dedup, op2_warc, op3_mixing, op4_embeddings, op5_bpe, op6_quality, op7_url_filter, op8_lm, op9_spotsigs,
        op10_simhash, op11_conversation_repair, op12_html_text, op13_runs,
    )
}
ORACLES: dict[str, str] = {"op2_warc": WARC_SQL, "op7_url_filter": URL_SQL}
