"""All queries of this subpackage and their SQL."""

from streamlytics.llm import (  # noqa: F401
    additive_query,
    chat_query,
    decontaminate_query,
    divergence_query,
    fim_query,
    license_query,
    mixing_query,
    near_dup_query,
    packing_query,
    rare_features_query,
    sharding_query,
    toxicity_query,
    url_query,
)
from streamlytics.llm.common import ORACLES, QUERIES


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLES)
