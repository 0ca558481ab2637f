"""segloom.operators"""
