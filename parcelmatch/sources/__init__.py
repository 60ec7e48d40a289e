"""parcelmatch.sources"""
