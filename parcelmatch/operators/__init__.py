"""parcelmatch.operators"""
