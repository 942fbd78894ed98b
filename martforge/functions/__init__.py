"""martforge.functions"""
