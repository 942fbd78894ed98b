"""martforge.sources"""
