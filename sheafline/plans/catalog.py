"""All registered queries."""

from sheafline.plans import documents, embedding, events, metrics, office, reports, state, streams, text
from sheafline.plans.registry import ORACLES, QUERIES

SECTIONS = (events, text, office, embedding, reports, metrics, documents, streams, state)


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
