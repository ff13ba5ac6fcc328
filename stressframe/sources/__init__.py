"""stressframe.sources"""
