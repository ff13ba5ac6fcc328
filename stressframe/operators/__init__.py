"""stressframe.operators"""
