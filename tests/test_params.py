"""The registered queries run with the reference's parameters."""
from podium.plans import catalog, pipeline


def test_queries_run_the_reference_job():
    for p in (catalog.QUERY_PARAMS, pipeline.DEFAULT_PARAMS):
        assert (p["n_factors"], p["n_trees"], p["learning_rate"], p["candidate_pool_size"]) == (128, 300, 0.05, 100)
        assert (p["encoder_dim"], p["top_k"], p["diversity_penalty"]) == (384, 10, 0.1)
