"""martforge.streaming"""
