"""Queries of this subpackage by name, and SQL for those that SQL can express."""

from __future__ import annotations

from .decontaminate import op2_decontamination
from .html_text import op7_html_extraction
from .lang_id import op6_language_id
from .line_crf import op4_quality_classifier
from .lines import op5_line_dedup
from .mixing import OP3_SQL, op3_mixing
from .pii import op13_pii
from .quality_rules import op9_quality_rules
from .ranking import OP12_SQL, op12_ranked_search
from .secrets import op8_secret_scans
from .simhash import op1_simhash
from .urls import op10_url_filters
from .whitening import op11_embedding_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash, op2_decontamination, op3_mixing, op4_quality_classifier, op5_line_dedup, op6_language_id,
        op7_html_extraction, op8_secret_scans, op9_quality_rules, op10_url_filters,
        op11_embedding_whitening, op12_ranked_search, op13_pii,
    )
}

ORACLE = {"op3_mixing": OP3_SQL, "op12_ranked_search": OP12_SQL}
