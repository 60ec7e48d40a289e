"""parcelmatch.plans"""
