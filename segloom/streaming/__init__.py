"""segloom.streaming"""
