"""stressframe.streaming"""
