"""martforge.operators"""
