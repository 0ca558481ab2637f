"""segloom.sources"""
