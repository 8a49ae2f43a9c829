"""Paths and helpers that the test modules share."""
SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def run_pipeline(*args, **kw):
    """The full job under the contracts of the test tables."""
    from lakehold.plans import jobs
    from lakehold.sources.testdata import CONTRACTS
    return jobs.run_pipeline(*args, contracts=CONTRACTS, **kw)
