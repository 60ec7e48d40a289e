"""parcelmatch.streaming"""
