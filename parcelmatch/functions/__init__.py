"""parcelmatch.functions"""
